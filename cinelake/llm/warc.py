"""WARC archives of pages, compressed record by record with a dictionary.

A file (``.warc.zst``) begins with a skippable frame that holds a Zstandard
dictionary built from the file's own first records (up to ``SAMPLE_BYTES``).
Every record follows as one frame compressed with it, so a record can be read alone.
Of pages with equal payloads of at least ``least_bytes`` bytes, those with the
smallest page_id are response records; the others are revisit records without
payload, whose HTTP head keeps the length and whose fields name the response.

Equal payloads meet as digests with a pre-aggregated minimum, so a payload that
many pages share is no large group, and its pages are a skewed join key that
Spark splits. Every attempt of a task writes a file of its own name; the
manifest names those of successful attempts.

No two records share a record id: that of a response, which revisits name, is made of
its page_id and payload where no other row has both; all others are made of the file's name and
the record's number, and revisits of such a response name it by page_id and digest only.

Defined results: null html is the empty payload; null urls become
``urn:page:<id>``; pages that share the smallest page_id of their payload are
all responses; a null page_id revisits the smallest id, and is a response where there is
none; an empty table gives no rows. Only the three named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.tables import SharedFiles, fresh_path, prepare

#: Fixed value: the skippable frame of a dictionary in a compressed archive.
DICTIONARY_FRAME = 0x184D2A5D

#: Bytes of records a file's dictionary is built from, its size, compression level.
SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 2 << 20, 1 << 15, 3

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 16


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(text: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, text)}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           only: bool = True, place: str = "") -> bytes:
    """A response record, or a revisit record if ``refers_to`` is given. ``only``: no other
    row has the response's page_id and payload; ``place``: a text no other record has."""
    digest = payload_digest(payload)
    own = _name(f"page {page_id} {digest}" if only and refers_to is None else f"place {place}")
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = head if refers_to is not None else head + payload
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", own),
              ("WARC-Date", DATE), ("WARC-Target-URI", target),
              ("WARC-Payload-Digest", "sha1:" + digest)]
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("Refers-To-Page-ID", refers_to)]
        if only:
            fields.append(("WARC-Refers-To", _name(f"page {refers_to} {digest}")))
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the records; too few to train on serve as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8, level=LEVEL)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[:DICTIONARY_BYTES],
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Writer:
    """Writes one archive; holds the first records until the dictionary is built."""

    def __init__(self, file):
        self.file, self.first, self.size, self.packer = file, [], 0, None

    def add(self, data: bytes) -> None:
        if self.packer is not None:
            self.file.write(self.packer.compress(data))
            return
        self.first.append(data)
        self.size += len(data)
        if self.size >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        made = dictionary(self.first)
        body = made.as_bytes()
        self.file.write(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
        made.precompute_compress(level=LEVEL)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=made)
        for data in self.first:
            self.file.write(self.packer.compress(data))
        self.first = []

    def close(self) -> None:
        if self.packer is None and self.first:
            self._begin()
        self.file.close()


def records(file) -> Iterator[bytes]:
    """The records of one archive, one at a time."""
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with its dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(file.read(size)))
    rest = file.read(_CHUNK)
    while rest:
        frame, out = unpacker.decompressobj(), []
        while True:
            out.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data or file.read(_CHUNK)
                break
            rest = file.read(_CHUNK)
            if not rest:
                raise ValueError("the archive ends within a record")
        yield b"".join(out)


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def read_record(data: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to); a response's payload is checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block, end = rest[:int(fields["Content-Length"])], rest[int(fields["Content-Length"]):]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if end != b"\r\n\r\n" or kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("Page-ID"), size, digest, kind, number("Refers-To-Page-ID")


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> list[str]:
    """Write the archives; returns their names (one a partition)."""
    prepare(pages.sparkSession)
    payload = F.encode(F.coalesce(pages["html"].cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload")) \
        .withColumn("size", F.length("payload"))
    same = rows.groupBy("digest", "size", "page_id").agg(F.count(F.lit(1)).alias("n"))
    first = same.groupBy("digest", "size").agg(F.min("page_id").alias("least"),
                                               F.min_by("n", "page_id").eqNullSafe(1).alias("only"))
    again = (F.col("size") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("least"))
    typed = rows.join(first, ["digest", "size"]).select("page_id", "url", "payload",
                                                        F.when(again, F.col("least")).alias("refers_to"),
                                                        # below the least size all are responses
                                                        (F.col("only") & (F.col("size") >= least_bytes)).alias("only"))

    def run(batches):
        writer, name, number = None, "", 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None:
                    name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
                    writer = Writer(SharedFiles(folder).write(name))
                writer.add(record(*row, f"{name} {number}"))
                number += 1
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays([pa.array([name])], ["file"])

    return sorted(r["file"] for r in typed.mapInArrow(run, "file string").collect())


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark, folder: str, files: list[str]) -> DataFrame:
    """One row of every record in the archives."""
    prepare(spark)
    named = spark.createDataFrame([(f,) for f in files], "file string").repartition(max(1, len(files)))
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = [c.split()[0] for c in PAGES.split(", ")]

    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with SharedFiles(folder).read(name) as file:
                    rows = []
                    for data in records(file):
                        rows.append(read_record(data))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return named.mapInArrow(run, PAGES)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive all pages in a new folder of the shared work folder and read the archives back."""
    folder = fresh_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, folder, write(pages, folder))
