"""Words of a byte-level tokenizer's pre-tokenizer, for many texts at once.

Texts whose characters all lie below U+0530 are split with array operations on
character classes, and equal words of a batch are found by Arrow's dictionary
encoding, so that only distinct words become Python strings. Other texts, and
those with a special token's string, are split by the pattern.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import regex

#: Fixed value: the word pattern of the byte-level pre-tokenizer.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: From the first code point that some Unicode version has not assigned.
LATER = regex.compile("[԰-\U0010ffff]")

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _classes() -> np.ndarray:
    found = []
    for code in range(0x530):
        char = chr(code)
        kind = next((k for k, p in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s"))
                     if regex.match(p, char)), _OTHER)
        found.append(kind)
    return np.array(found, np.int8)


_CLASS = _classes()


def _starts(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """True where a word starts; ``begins`` are the texts' first places, all within ``codes``."""
    n, kind = len(codes), _CLASS[codes]
    first = np.zeros(n, bool)
    first[begins] = True
    run = first.copy()
    run[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(run)
    ends = np.append(at[1:], n)
    start = run.copy()
    # White space before a word: the last one stands apart, and a blank joins the word.
    inner = ~first[at]
    joined = at[inner & (kind[at] != _SPACE)]
    joined = joined[kind[joined - 1] == _SPACE]
    start[joined - 1] = True
    blank = joined[codes[joined - 1] == 32]
    start[blank] = False
    # A lone apostrophe without a blank, before one of the endings, takes it along.
    marks = at[(codes[at] == 39) & (ends - at == 1) & (ends < n)]
    marks = marks[start[marks] & ~first[np.minimum(marks + 1, n - 1)]]
    if len(marks):
        one, two = codes[marks + 1], codes[np.minimum(marks + 2, n - 1)]
        two = np.where((marks + 2 < n) & ~first[np.minimum(marks + 2, n - 1)], two, 0)
        size = np.where(np.isin(one, [115, 116, 109, 100]), 2, 0)  # 's 't 'm 'd
        pair = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
        size = np.where(pair, 3, size)  # 're 've 'll
        marks, size = marks[size > 0], size[size > 0]
        start[marks + 1] = False
        after = marks + size
        after = after[after < n]
        start[after[kind[after] == _LETTER]] = True
    return start


class Splitter:
    """Splits texts into the words that the tokenizer file's pre-tokenizer makes."""

    def __init__(self, spec: dict):
        if (spec.get("normalizer"), spec["pre_tokenizer"]["type"]) != (None, "ByteLevel"):
            raise ValueError("a byte-level tokenizer file without a normalizer is needed")
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.pattern = regex.compile(WORD)
        self.parts = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(
            self.special, key=len, reverse=True)) + ")")
        self._library = None

    def words(self, text: str) -> list[str]:
        """The text's words; a special token's string is a word of its own."""
        if not any(s in text for s in self.special):
            return self._plain(text)
        out = []
        for part in self.parts.split(text):
            out += [part] if part in self.special else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        """The pattern's matches. Where ``regex`` may know letters of a newer
        Unicode than the tokenizer does, the tokenizer's own splitter decides."""
        if LATER.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            if self._library is None:
                from tokenizers.pre_tokenizers import ByteLevel
                self._library = ByteLevel(add_prefix_space=False)
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        return self.pattern.findall(text)

    def batch(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct words, each word's place among them, first word of each text and the end)."""
        simple = [t.isascii() or not LATER.search(t) for t in texts]
        simple = [s and not any(x in t for x in self.special) for s, t in zip(simple, texts)]
        plain = [t for s, t in zip(simple, texts) if s and t]
        words, counts = [], np.zeros(len(texts), np.int64)
        if plain:
            joined = "".join(plain)
            codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            begins = np.cumsum([0, *map(len, plain)])
            at = np.flatnonzero(_starts(codes, begins[:-1]))
            offsets = np.append(at, len(codes))
            if not joined.isascii():
                offsets += np.concatenate([[0], np.cumsum(codes >= 128)])[offsets]
            data = joined.encode()
            words.append(pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)))
            counts[[k for k, t in enumerate(texts) if simple[k] and t]] = np.diff(np.searchsorted(at, begins))
        others = [k for k, s in enumerate(simple) if not s]
        for k in others:
            words.append(pa.array(self.words(texts[k]), pa.string()))
            counts[k] = len(words[-1])
        ends = np.concatenate([[0], np.cumsum(counts)])
        if not words:
            return [], np.zeros(0, np.int64), ends
        code = pa.concat_arrays(words).dictionary_encode()
        places = code.indices.to_numpy()
        if others and plain:  # back to the texts' order
            texts_of = np.concatenate([np.flatnonzero(simple), others]).astype(np.int64)
            places = places[np.argsort(np.repeat(texts_of, counts[texts_of]), kind="stable")]
        return code.dictionary.to_pylist(), places, ends


_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def white_words(texts: list[str], lower: bool = False) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words between the six ASCII white spaces: (distinct words, each word's
    place among them, first word of each text and the end). lower: A-Z become a-z."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b" ".join(parts), np.uint8)
    if not len(data):
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    solid = ~_WHITE[data]
    starts = solid.copy()
    starts[1:] &= ~solid[:-1]
    at = np.flatnonzero(starts)
    kept = data[solid]
    if lower:
        kept = _LOWER[kept]
    places_kept = np.cumsum(solid)
    offsets = np.append(places_kept[at] - 1, len(kept)).astype(np.int32)
    begins = np.cumsum([0, *(len(p) + 1 for p in parts)])
    code = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(kept)).dictionary_encode()
    return code.dictionary.to_pylist(), code.indices.to_numpy().astype(np.int64), np.searchsorted(at, begins)


class WordTable:
    """Ids of words in one array, so that many words' ids are gathered at once."""

    def __init__(self, most: int, kind=np.uint32):
        self.most, self.kind = most, kind
        self.rows: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.rows.clear()
        self.flat, self.begins, self.used = np.zeros(1 << 16, self.kind), np.zeros(1 << 16, np.int64), 0

    def missing(self, words: list[str]) -> list[str]:
        """Words without ids. Beyond ``most`` words the table begins anew first."""
        if len(self.rows) > self.most:
            self._clear()
        rows = self.rows
        return [w for w in words if w not in rows]

    def add(self, words: list[str], ids: list[int], sizes: list[int]) -> None:
        """Words with their ids after each other."""
        first, end = len(self.rows), self.used + len(ids)
        while end > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(words) + 1 > len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.flat[self.used:end] = ids
        self.begins[first + 1:first + 1 + len(words)] = self.used + np.cumsum(sizes)
        self.used = end
        self.rows.update(zip(words, range(first, first + len(words))))

    def gather(self, words: list[str], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``words[place]`` of all places after each other, and where each place's begin (and the end)."""
        rows = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))[places]
        begins = self.begins[rows]
        sizes = self.begins[rows + 1] - begins
        ends = np.concatenate([[0], np.cumsum(sizes)])
        index = np.arange(ends[-1])
        index += np.repeat(begins - ends[:-1], sizes)
        return self.flat[index], ends
