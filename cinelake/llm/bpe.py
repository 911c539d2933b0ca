"""Byte-pair encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a batch form a trie over bytes. Its nodes are visited
depth first, and each node gets one state: the last token of the encoding of
its prefix. A prefix ``p`` ends in token ``t`` exactly if ``t`` is a suffix of
``p`` and the merges keep ``last(p without t)`` and ``t`` apart, so a state
follows from states nearer the root, and the encoding of a prefix that many
words share is computed once. A word's tokens are read back along its states.

Defined results: a null text reads as empty and gives no tokens; special token
strings of the file are matched first, as the tokenizer does; repeated rows
each give a row; an empty table gives none; only the named columns are read,
so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cinelake.llm.pretokens import Splitter, WordTable
from cinelake.llm.tables import map_batches, prepare, texts, worker_cache

#: Words and token pairs kept between batches; beyond it a worker forgets them (results are the same).
WORDS_KEPT, PAIRS_KEPT = 1_000_000, 400_000

DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others, in order, for the code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.splitter = Splitter(spec)
        self.special = self.splitter.special
        byte = _byte_of_char()
        raw = lambda token: bytes(byte[c] for c in token)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()
                 if t not in {a["content"] for a in spec["added_tokens"]}}
        size = 1 + max([*vocab.values(), *(a["id"] for a in spec["added_tokens"])])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = token
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = map(raw, pair if isinstance(pair, list) else pair.split(" "))
            self.merges[vocab[left], vocab[right]] = rank, vocab[left + right]
        self.single = [vocab[bytes([b])] for b in range(256)]
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.length = [len(t) for t in self.bytes_of]
        self.longest = max(len(t) for t in vocab)
        self.digits = [str(i) for i in range(size)]
        self.suffixes = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in vocab.items():
            self.suffixes.add_word(token.decode("latin-1"), i)
        self.suffixes.make_automaton()
        self.known = WordTable(WORDS_KEPT)
        self._apart: dict[tuple[int, int], bool] = {}

    # -- merges, for one or two tokens only ---------------------------------

    def _merged(self, data: bytes) -> list[int]:
        """The encoding of a short string by its merges, lowest rank first."""
        ids = [self.single[b] for b in data]
        while len(ids) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges),
                       default=None)
            if best is None:
                break
            k = best[1]
            ids[k:k + 2] = [self.merges[ids[k], ids[k + 1]][1]]
        return ids

    def apart(self, left: int, right: int) -> bool:
        """True if the two tokens stay as they are side by side (left -1: start of the word)."""
        found = self._apart.get((left, right))
        if found is None:
            pair = [right] if left < 0 else [left, right]
            found = self._merged(b"".join(self.bytes_of[i] for i in pair)) == pair
            self._apart[left, right] = found
        return found

    # -- the trie ------------------------------------------------------------

    def learn(self, words) -> None:
        """Encode words into ``known``. Sorted byte strings are a depth-first
        walk of their trie; ``last`` holds the states of the path to the
        current node, and moving to the next word keeps those of the shared
        prefix."""
        rows = sorted((w.encode().decode("latin-1"), w) for w in words)
        path, last, length, longest = "", [-1], self.length, self.longest
        ending, kept = self.suffixes.iter, self._apart
        flat, sizes = [], []
        for key, word in rows:
            shared, least = 0, min(len(path), len(key))
            while shared < least and path[shared] == key[shared]:
                shared += 1
            del last[shared + 1:]
            for end, token in ending(key, max(0, shared + 1 - longest)):
                if end == shared:  # the next node without a state
                    pair = last[end + 1 - length[token]], token
                    apart = kept.get(pair)
                    if apart is None:
                        apart = self.apart(*pair)
                    if apart:
                        last.append(token)
                        shared += 1
            tokens, depth = [], len(key)
            while depth:
                token = last[depth]
                tokens.append(token)
                depth -= length[token]
            tokens.reverse()
            flat += tokens
            sizes.append(len(tokens))
            path = key
        self.known.add([word for _, word in rows], flat, sizes)

    # -- texts -----------------------------------------------------------------

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts after each other, and where each text's begin (and the end)."""
        if len(self._apart) > PAIRS_KEPT:
            self._apart.clear()
        words, places, firsts = self.splitter.batch(batch)
        missing = self.known.missing(words)
        own = [w for w in missing if w in self.special]
        self.known.add(own, [self.special[w] for w in own], [1] * len(own))
        self.learn([w for w in missing if w not in self.special])
        ids, ends = self.known.gather(words, places)
        return ids, ends[firsts]

    def decode(self, ids) -> str:
        """The text of token ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def joined(self, ids) -> str:
        return ",".join(map(self.digits.__getitem__, ids))


def codec(path: str) -> Codec:
    """The worker's codec."""
    return worker_cache(("codec", path), lambda: Codec(path))


def encode(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids array<int>) of every text."""
    prepare(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = codec(vocab_path).encode(texts(batch.column(1)))
        rows = pa.ListArray.from_arrays(ends.astype(np.int32), ids.astype(np.int32))
        return pa.RecordBatch.from_arrays([batch.column(0), rows], ["doc_id", "ids"])

    return map_batches(_two(docs, key, text), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, text) of ``encode``'s rows; null ids read as none."""
    prepare(encoded.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [codec(vocab_path).decode(ids or []) for ids in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, vocab_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Encode and decode every text: token count, SHA-256 of the ids in
    decimal joined by commas, SHA-256 of the decoded text."""
    prepare(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(vocab_path)
        counts, ids_sha, text_sha = [], [], []
        every, ends = own.encode(texts(batch.column(1)))
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            ids = every[a:b].tolist()
            counts.append(b - a)
            ids_sha.append(hashlib.sha256(own.joined(ids).encode()).hexdigest())
            text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
             pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(_two(docs, key, text), run, DIGEST_SCHEMA)


def _two(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
