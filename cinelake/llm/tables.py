"""Shared helpers: table access, staged tables, shared files, package shipping."""

from __future__ import annotations

import io
import os
import zipfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import fresh_path, tune

#: Rows and bytes of one Arrow batch: bounds a Python worker's memory whatever
#: the texts' lengths are (one longer row still travels alone).
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

_SHIPPED = "_cinelake_shipped"


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, and this package on every worker."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if not getattr(context, _SHIPPED, False):
        context.addPyFile(_package_zip(spark))
        setattr(context, _SHIPPED, True)
    return spark


def _package_zip(spark: SparkSession) -> str:
    """The package's sources as one zip in the shared folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    folder, name = fresh_path(spark, "package"), "cinelake_src.zip"
    with SharedFiles(folder).write(name) as file:
        file.write(packed.getvalue())
    return f"{folder}/{name}"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts lineage: what follows reads the files, so neither a lost executor nor
    a second use computes ``df`` again.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch; empty input gives no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


_worker_cache: dict = {}


def worker_cache(key, make: Callable):
    """An object that a worker keeps between batches and tasks. A worker keeps
    one: another operator's replaces it, so their sizes do not add up."""
    if key not in _worker_cache:
        _worker_cache.clear()
        _worker_cache[key] = make()
    return _worker_cache[key]


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column; null reads as the empty text."""
    return [t or "" for t in column.to_pylist()]


def bucket(column: str, buckets: int):
    """crc32 of the id's decimal text modulo ``buckets`` (null counts as '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % buckets


def crc_bucket(value, buckets: int) -> int:
    """``bucket`` for one Python value."""
    return zlib.crc32(b"" if value is None else str(value).encode()) % buckets


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not use (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


#: Bits of the maps that are sent to all tasks (8 MB), and of one row of Spark's bit map functions.
BITS, _BITS_A_ROW = 1 << 26, 1 << 15


def bit_map(rows: DataFrame, key: Column) -> bytes:
    """Map of the rows' keys (a long) modulo BITS; at most BITS / 32768 rows
    of 4096 bytes come to the driver."""
    place = F.pmod(key, F.lit(BITS).cast("long")) + 1  # Spark's bit maps count from 1
    parts = rows.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in parts.collect():
        start = (r["b"] - 1) * (_BITS_A_ROW // 8)
        out[start:start + len(r["m"])] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out.tobytes()


def without(df: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` (never null) is not in ``dropped``. Only
    rows that a bit map of the dropped keys lets through are shuffled, for the exact
    anti-join; the others pass where they lie, texts and all."""
    shared = df.sparkSession.sparkContext.broadcast(bit_map(dropped, F.xxhash64(key)))

    def marked(place: pd.Series) -> pd.Series:
        bits, at = np.frombuffer(shared.value, np.uint8), place.to_numpy()
        return pd.Series(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0)

    maybe = F.pandas_udf(marked, "boolean")(F.pmod(F.xxhash64(key), F.lit(BITS).cast("long")))
    return df.where(~maybe).unionByName(df.where(maybe).join(dropped.select(key), key, "left_anti").select(df.columns))


class SharedFiles:
    """Files in the shared work folder from inside a task, by Arrow's file
    systems, so that the folder may be local, on HDFS or in an object store."""

    def __init__(self, folder: str):
        from pyarrow import fs
        if folder.startswith("file:/") and not folder.startswith("file://"):
            folder = folder[len("file:"):]
        self.fs, self.root = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder)

    def write(self, name: str) -> pa.NativeFile:
        self.fs.create_dir(self.root, recursive=True)
        return self.fs.open_output_stream(f"{self.root}/{name}", compression=None)

    def read(self, name: str) -> pa.NativeFile:
        return self.fs.open_input_file(f"{self.root}/{name}")

    def remove(self, name: str) -> None:
        self.fs.delete_file(f"{self.root}/{name}")


def read_bytes(file, offset: int, size: int) -> bytes:
    file.seek(offset)
    return file.read(size)
