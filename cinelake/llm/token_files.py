"""Token ids in seekable zstandard files.

A file holds whole documents in ascending doc_id order. Its parts:

* data frames: independent zstandard frames of ids as little-endian unsigned
  32-bit integers, each ending at the end of a document;
* one skippable frame with the documents' index (doc_id, frame, place, ids);
* the trailing seek table of the public seekable format: a skippable frame
  with each frame's compressed size, decompressed size and checksum (low 32
  bits of XXH64 of the decompressed bytes), and a footer that gives its length.

A reader finds a document from the file's end and decompresses its frame only.
Every attempt of a task writes a file of its own name; the manifest names the
files of the attempts that succeeded, so lost executors leave no damage.

Defined results: a null text reads as empty (the end id alone); null doc_ids
come first; rows that share a doc_id follow each other in table order; an empty table gives no
rows. Only the two named columns are read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from itertools import accumulate, chain

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.bpe import WORDS_KEPT
from cinelake.llm.pretokens import Splitter, WordTable
from cinelake.llm.tables import SharedFiles, fresh_path, map_batches, prepare, read_bytes, texts, worker_cache

#: Fixed values of the seekable format.
SKIPPABLE, SEEK_FRAME, SEEK_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

#: Decompressed bytes after which a data frame ends with the current document.
FRAME_BYTES = 1 << 18


class LibraryEncoder:
    """The tokenizers library on distinct words, each word's ids packed once."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            self.splitter = Splitter(json.load(file))
        self.known = WordTable(WORDS_KEPT)

    def packed(self, batch: list[str], end_id: int) -> list[bytes]:
        """The ids of each text and the end id, as little-endian unsigned 32-bit integers."""
        words, places, firsts = self.splitter.batch(batch)
        fresh = self.known.missing(words)
        codes = [code.ids for code in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        self.known.add(fresh, list(chain.from_iterable(codes)), list(map(len, codes)))
        ids, ends = self.known.gather(words, places)
        cuts, end = ends[firsts].tolist(), struct.pack("<I", end_id)
        return [ids[a:b].tobytes() + end for a, b in zip(cuts, cuts[1:])]


def library(path: str) -> LibraryEncoder:
    """The worker's encoder."""
    return worker_cache(("library", path), lambda: LibraryEncoder(path))


class SeekableWriter:
    """Writes one file; ``add`` takes documents in order."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES):
        self.file, self.frame_bytes = file, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=3)
        self.parts: list[bytes] = []
        self.size, self.docs, self.ids = 0, 0, 0
        self.seek: list[bytes] = []
        self.index: list[tuple] = []

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.index.append((doc_id or 0, len(self.seek) | (1 << 31 if doc_id is None else 0),
                           self.size // 4, len(packed) // 4))
        self.parts.append(packed)
        self.size += len(packed)
        self.docs, self.ids = self.docs + 1, self.ids + len(packed) // 4
        if self.size >= self.frame_bytes:
            self._frame()

    def _frame(self) -> None:
        data = b"".join(self.parts)
        frame = self.packer.compress(data)
        self.file.write(frame)
        self.seek.append(struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.parts, self.size = [], 0

    def close(self) -> None:
        if self.parts:
            self._frame()
        body = self.packer.compress(b"".join(struct.pack("<qIII", *row) for row in self.index))
        self.file.write(struct.pack("<II", SKIPPABLE, len(body)) + body)
        self.seek.append(struct.pack("<III", len(body) + 8, 0, 0))
        self.file.write(struct.pack("<II", SEEK_FRAME, 12 * len(self.seek) + 9) + b"".join(self.seek)
                        + struct.pack("<IBI", len(self.seek), CHECKSUMS, SEEK_MAGIC))
        self.file.close()


class SeekableReader:
    """Reads documents of one file by their place in it."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        count, flags, magic = struct.unpack("<IBI", read_bytes(file, size - 9, 9))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the file's end")
        table = read_bytes(file, size - 9 - 12 * count, 12 * count)
        self.seek = list(struct.iter_unpack("<III", table))
        self.starts = list(accumulate((s[0] for s in self.seek), initial=0))
        body = read_bytes(file, self.starts[-2] + 8, self.seek[-1][0] - 8)
        #: (doc_id or None, frame, place, ids) in file order.
        self.index = [(None if frame >> 31 else doc_id, frame & 0x7FFFFFFF, place, n) for doc_id, frame, place, n
                      in struct.iter_unpack("<qIII", zstandard.ZstdDecompressor().decompress(body))]
        self._frame, self._data = -1, b""

    def ids(self, frame: int, place: int, count: int) -> bytes:
        """Packed ids of one document; only its frame is decompressed, and checked."""
        if frame != self._frame:
            packed, size, checksum = self.seek[frame]
            data = zstandard.ZstdDecompressor().decompress(
                read_bytes(self.file, self.starts[frame], packed), max_output_size=size)
            if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {frame} is damaged")
            self._frame, self._data = frame, data
        return self._data[4 * place:4 * (place + count)]


MANIFEST = "part int, file string, n_docs long, n_ids long"


def write(docs: DataFrame, folder: str, vocab_path: str, end_id: int, text: str = "text",
          key: str = "doc_id", frame_bytes: int = FRAME_BYTES) -> list[tuple[int, str, int, int]]:
    """Encode every text and write the files; returns the manifest's rows in
    file order (one a file, so as many as partitions)."""
    prepare(docs.sparkSession)
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("place"))
    ordered = rows.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")

    def run(batches):
        part, writer, name = TaskContext.get().partitionId(), None, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
                writer = SeekableWriter(SharedFiles(folder).write(name), frame_bytes)
            packed = library(vocab_path).packed(texts(batch.column(1)), end_id)
            for doc_id, data in zip(batch.column(0).to_pylist(), packed):
                writer.add(doc_id, data)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([name]), pa.array([writer.docs], pa.int64()),
                 pa.array([writer.ids], pa.int64())], ["part", "file", "n_docs", "n_ids"])

    return sorted(tuple(r) for r in ordered.mapInArrow(run, MANIFEST).collect())


def read_digests(spark, folder: str, manifest: list[tuple[int, str, int, int]]) -> DataFrame:
    """Read the files back: (doc_id, start, n_tokens, ids_crc32) of every document."""
    prepare(spark)
    starts = accumulate((m[3] for m in manifest), initial=0)
    files = spark.createDataFrame([(m[1], s) for m, s in zip(manifest, starts)], "file string, start long")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, list, list, list] = [], [], [], []
        for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with SharedFiles(folder).read(name) as file:
                reader = SeekableReader(file)
                for doc_id, frame, place, count in reader.index:
                    for column, value in zip(out, (doc_id, start, count,
                                                   zlib.crc32(reader.ids(frame, place, count)))):
                        column.append(value)
                    start += count
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out],
                                          ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_batches(files.repartition(max(1, len(manifest))), run,
                       "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocab_path: str, end_id: int = 2) -> DataFrame:
    """Write all documents to a new folder of the shared work folder and read them back."""
    folder = fresh_path(docs.sparkSession, "token-files")
    return read_digests(docs.sparkSession, folder, write(docs, folder, vocab_path, end_id))
