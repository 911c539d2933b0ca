"""Bounded results of a stream: documents by id, open windows, commit records.

All three live in a folder the cluster shares and are changed by one commit: a
small file that is written aside and renamed. What a lost job has written before its commit is
not read, and the replayed batch writes it again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators.relational import top_k_per_group

#: Folders that the documents of a store are hashed into: about one file each.
BUCKETS = 32


class Folder:
    """A shared folder through the cluster's file system."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self.path = path.rstrip("/")
        self.fs = self._path(self.path).getFileSystem(context._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        folder = self._path(self.path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def commit(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        aside, final = self._path(f"{self.path}/.{name}-{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        stream = self.fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.fs.delete(final, False)
        if not self.fs.rename(aside, final):
            raise OSError(f"{final} was not committed")

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.path}/{name}"), True)


class Versions:
    """Commits of batches under ``<path>/_commits``: the newest one counts, the one
    before it is kept for readers that have begun."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, f"{path.rstrip('/')}/_commits")

    def _ids(self) -> list[int]:
        return sorted(int(n) for n in self.folder.names() if n.isdigit())

    def last(self) -> int:
        return max(self._ids(), default=-1)

    def get(self) -> dict:
        last = self.last()
        return json.loads(self.folder.read(f"{last:020d}")) if last >= 0 else {}

    def commit(self, batch_id: int, content: dict | None = None) -> None:
        self.folder.commit(f"{batch_id:020d}", json.dumps(content or {}))
        for old in self._ids()[:-2]:
            self.folder.remove(f"{old:020d}")

    def kept(self) -> list[dict]:
        return [json.loads(self.folder.read(f"{n:020d}")) for n in self._ids()]


def compute(batch: DataFrame) -> None:
    """Runs a batch that a sink has already: the query's state needs it."""
    batch.write.format("noop").mode("overwrite").save()


def with_window_end(df: DataFrame) -> DataFrame:
    if "window" in df.columns and "window_end" not in df.columns:
        return df.withColumn("window_end", F.col("window.end"))
    return df


class DocumentStore:
    """The newest row of each document (ST12, S14): the greatest ``order``.

    Documents are hashed into ``buckets`` folders. A batch rewrites the buckets it
    touches, in one job whose tasks hold a bucket each, into a folder of its own;
    its commit says where each bucket lies, and folders that neither it nor the commit
    before names are removed after it. So files do not grow with the number of
    batches, a batch lost half-way leaves the last commit as it was, and a batch
    that is replayed after its commit changes nothing."""

    def __init__(self, spark: SparkSession, path: str, order: Sequence[str] = ("window_end", "batch_id"),
                 key: str = "doc_id", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.order, self.buckets = spark, path.rstrip("/"), key, list(order), buckets
        self.versions = Versions(spark, self.path)

    def read(self) -> DataFrame | None:
        """The documents of the last commit; None before the first document."""
        places = self.versions.get().get("buckets", {})
        return self._read(places.values()) if places else None

    def _read(self, folders) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in folders])

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self.versions.last():
            return compute(batch)
        places = self.versions.get().get("buckets", {})
        batch = with_window_end(batch).withColumn("batch_id", F.lit(batch_id).cast("long")).persist()
        try:
            places = self._written(batch, batch_id, places)
        finally:
            batch.unpersist()
        self.versions.commit(batch_id, {"buckets": places})
        self._clear()

    def _written(self, rows: DataFrame, batch_id: int, places: dict[str, str]) -> dict[str, str]:
        """Where each bucket lies once the batch is merged."""
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("doc_bucket")
        touched = [str(r[0]) for r in rows.select(bucket).distinct().collect()]  # ``buckets`` numbers at most
        if touched:
            known = [places[b] for b in touched if b in places]
            if known:
                rows = rows.unionByName(self._read(known))
            dealt = rows.select("*", bucket).repartition(len(touched), "doc_bucket")
            newest = top_k_per_group(dealt, ["doc_bucket", self.key], [F.desc(c) for c in self.order], 1)
            folder = f"v={batch_id}-{uuid.uuid4().hex[:8]}"
            newest.write.partitionBy("doc_bucket").parquet(f"{self.path}/{folder}")
            places = {**places, **{b: f"{folder}/doc_bucket={b}" for b in touched}}
        return places

    def _clear(self) -> None:
        named = {p for kept in self.versions.kept() for p in kept.get("buckets", {}).values()}
        folder = Folder(self.spark, self.path)
        for name in folder.names():
            if not name.startswith("v="):
                continue
            own = Folder(self.spark, f"{self.path}/{name}").names()
            stale = [b for b in own if b.startswith("doc_bucket=") and f"{name}/{b}" not in named]
            if not any(f"{name}/{b}" in named for b in own):
                folder.remove(name)
            else:
                for bucket in stale:
                    folder.remove(f"{name}/{bucket}")


class WindowHistory:
    """Windows that are still open, and the history of closed ones (S15), from the update
    rows of one stateful query. A batch adds its rows to the open windows; those whose
    end the batch's watermark has passed are final (Spark drops later events for
    them), go to ``<path>/batch_id=N`` and are open no more. The open ones,
    as many as the watermark's delay holds, are written anew by each batch, whose commit says where."""

    def __init__(self, spark: SparkSession, path: str, open_path: str, keys: Sequence[str]):
        self.spark, self.path, self.open_path, self.keys = spark, path.rstrip("/"), open_path.rstrip("/"), list(keys)
        self.versions = Versions(spark, self.open_path)

    def advance(self, updates: DataFrame, batch_id: int, watermark_ms: int) -> DataFrame:
        """Adds a batch; returns the windows that it closes."""
        schema = updates.schema
        here = f"{self.path}/batch_id={batch_id}"
        if batch_id > self.versions.last():
            place = self.versions.get().get("open")
            rows = updates.withColumn("__batch", F.lit(batch_id).cast("long"))
            if place:
                rows = rows.unionByName(self.spark.read.schema(rows.schema).parquet(f"{self.open_path}/{place}"))
            newest = top_k_per_group(rows, ["window", *self.keys], [F.desc("__batch")], 1)
            closed = F.unix_millis("window.end") <= watermark_ms
            folder = f"v={batch_id}-{uuid.uuid4().hex[:8]}"
            newest.withColumn("__closed", closed).write.partitionBy("__closed").parquet(f"{self.open_path}/{folder}")
            self._folded(folder, rows.schema, "true").select(*schema.names).write.mode("overwrite").parquet(here)
            there = Folder(self.spark, f"{self.open_path}/{folder}").names()
            self.versions.commit(batch_id, {"open": f"{folder}/__closed=false" if "__closed=false" in there else None})
            named = {(kept.get("open") or "").split("/")[0] for kept in self.versions.kept()}
            files = Folder(self.spark, self.open_path)
            for name in files.names():
                if name.startswith("v=") and name not in named:
                    files.remove(name)
        return self.spark.read.schema(schema).parquet(here)

    def _folded(self, folder: str, schema, closed: str) -> DataFrame:
        path = f"{self.open_path}/{folder}"
        if f"__closed={closed}" not in Folder(self.spark, path).names():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{path}/__closed={closed}")


def batch_watermark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark (milliseconds) that Spark has logged for a batch before running it."""
    log = Folder(spark, f"{checkpoint.rstrip('/')}/offsets").read(str(batch_id))
    return json.loads(log.splitlines()[1])["batchWatermarkMs"]
