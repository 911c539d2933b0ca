"""Operators 1 and 4: against the tokenizers library."""

import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")

from cinelake.llm import bpe, token_files  # noqa: E402
from cinelake.llm.registry import QUERIES, tokenizer_path  # noqa: E402
from cinelake.llm.tables import SharedFiles, fresh_path  # noqa: E402

from cases import ODD, SF001  # noqa: E402

ALPHABETS = ["abcdefghijklmnopqrstuvwxyz     \n\t'''séèß0123456789.,!?#$%&<|>-_=ABC²½́\xa0\x1c\x85", "abc中文\U0001f642  '\n", "'strevmld  \n\t.a1", "' sA\n"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def random_text(draw):
    alphabet = draw.choice(ALPHABETS)
    text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60)))
    if draw.random() < 0.1:
        text = text[:9] + "<|endoftext|>" + text[9:]
    return text[:3] * 30 + text if draw.random() < 0.1 else text


def test_random_texts_equal_the_library(library):
    own, other, draw = bpe.Codec(tokenizer_path()), token_files.LibraryEncoder(tokenizer_path()), random.Random(1)
    for _ in range(300):
        batch = [random_text(draw) for _ in range(draw.randint(1, 9))]
        want = [library.encode(t, add_special_tokens=False).ids for t in batch]
        ids, ends = own.encode(batch)
        assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want
        assert [list(struct.unpack(f"<{len(p) // 4}I", p)) for p in other.packed(batch, 2)] == [w + [2] for w in want]
        assert [own.decode(w) for w in want] == [library.decode(w, skip_special_tokens=False) for w in want]


def test_every_character_below_the_table_limit_splits_like_the_library(library):
    splitter = bpe.Codec(tokenizer_path()).splitter
    for code in range(0x530):
        text = f"a{chr(code)}1 {chr(code) * 2}b !{chr(code)} {chr(code)}'s\n"
        words, places, _ = splitter.batch([text])
        want = [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]
        assert [words[k] for k in places] == want, hex(code)


def test_shared_prefixes_are_encoded_once(library):
    own = bpe.Codec(tokenizer_path())
    own.learn(["interest", "interested", "interesting", "interests", "in"])
    ids, _ = own.known.gather(["interesting"], np.array([0]))
    assert ids.tolist() == library.encode("interesting", add_special_tokens=False).ids


def want_digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def test_digests_of_odd_texts(spark, odd, none, library):
    got = sorted((tuple(r) for r in bpe.digests(odd, tokenizer_path()).collect()), key=repr)
    want = sorted(((r["doc_id"], *want_digests(library, r["text"])) for r in odd.collect()), key=repr)
    assert got == want
    assert bpe.digests(none, tokenizer_path()).count() == 0
    back = {r["doc_id"]: r["text"] for r in bpe.decode(bpe.encode(odd, tokenizer_path()), tokenizer_path()).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(ODD))


def test_op1_on_documents(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op1_bpe"](spark, SF001).collect()}
    assert got == {i: want_digests(library, t) for i, t in docs.items()}


def want_files(library, rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_op4_on_documents(spark, library):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op4_token_files"](spark, SF001).collect())
    assert got == want_files(library, docs)


def test_token_files_of_odd_texts(spark, odd, none, library):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = [r for r in rows if r[0] is None] + sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    got = sorted((tuple(r) for r in token_files.round_trip(odd, tokenizer_path()).collect()), key=lambda r: r[1])
    assert got == want_files(library, rows)
    assert token_files.round_trip(none, tokenizer_path()).count() == 0


def test_one_document_is_read_from_its_frame_and_damage_is_seen(spark):
    folder = fresh_path(spark, "seekable")
    writer = token_files.SeekableWriter(SharedFiles(folder).write("a"), frame_bytes=200)
    for i in range(30):
        writer.add(i if i else None, struct.pack("<20I", *range(i, i + 20)))
    writer.close()
    with SharedFiles(folder).read("a") as file:
        data = file.readall()
        reader = token_files.SeekableReader(file)
        assert len(reader.seek) > 5 and reader.index[0][0] is None
        _, frame, place, n = reader.index[17]
        assert struct.unpack("<20I", reader.ids(frame, place, n)) == tuple(range(17, 37))
        at = reader.starts[frame] + reader.seek[frame][0] // 2
    spoiled = bytearray(data)
    spoiled[at] ^= 255
    with SharedFiles(folder).write("b") as out:
        out.write(bytes(spoiled))
    with SharedFiles(folder).read("b") as file, pytest.raises(Exception):
        token_files.SeekableReader(file).ids(frame, place, n)


def test_files_are_standard_zstandard(spark):
    zstandard = pytest.importorskip("zstandard")
    folder = fresh_path(spark, "standard")
    writer = token_files.SeekableWriter(SharedFiles(folder).write("a"))
    writer.add(1, struct.pack("<3I", 7, 8, 9))
    writer.close()
    with SharedFiles(folder).read("a") as file:
        data = file.readall()
    out = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert out == struct.pack("<3I", 7, 8, 9)
