"""Stream sources, sinks and runners (S5, S12-S16, ST10-ST14).

A "topic" is either a broker (``format="kafka"`` plus its options; the
connector jar must be on the classpath) or a folder of key/value parquet
files, which is what tests and the registered queries use. Every query has
its own checkpoint folder, and every sink is idempotent per batch id: a
restarted query that replays a batch leaves the same output.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinelake.sources import zones
from cinelake.sources.schemas import MESSAGE
from cinelake.streaming.documents import DocumentStore, Folder, Versions, WindowHistory, batch_watermark, compute
from cinelake.streaming.messages import triage
from cinelake.streaming.windows import flatten_window


@dataclass
class Topic:
    """Where review messages live. ``fmt="parquet"``: ``path`` is a folder of
    key/value files. Any other format is a streaming connector: ``options``
    serve both directions (for Kafka: kafka.bootstrap.servers),
    ``read_options`` the subscriber (subscribe) and ``write_options`` the
    publisher (topic)."""
    path: str | None = None
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    read_options: Mapping[str, str] = field(default_factory=dict)
    write_options: Mapping[str, str] = field(default_factory=dict)


def publish(messages: DataFrame, topic: Topic) -> None:
    """Batch-append (key, value) rows to the topic."""
    if topic.fmt == "parquet":
        messages.write.mode("append").parquet(topic.path)
        return
    writer = messages.write.format(topic.fmt).mode("append")
    for k, v in {**topic.options, **topic.write_options}.items():
        writer = writer.option(k, v)
    writer.save()


def subscribe(spark: SparkSession, topic: Topic, options: Mapping[str, str] | None = None) -> DataFrame:
    """Streaming read of the topic: columns key, value (binary)."""
    reader = spark.readStream.format(topic.fmt)
    if topic.fmt == "parquet":
        reader = reader.schema(MESSAGE).option("recursiveFileLookup", "true")
    for k, v in {**topic.options, **topic.read_options, **(options or {})}.items():
        reader = reader.option(k, v)
    df = reader.load(topic.path) if topic.path else reader.load()
    return df.select("key", "value")


def divert(messages: DataFrame, events: str, dead_letters: str, checkpoint: str,
           trigger: Mapping | None = None) -> StreamingQuery:
    """Splits a topic in one query (ST1 F15): messages that hold an event go on to the folder topic
    ``events``, the others with their reason to the table ``dead_letters``. Both
    writes of a micro-batch come from one decoded copy; a replayed batch leaves them as they are."""
    spark, aside = messages.sparkSession, f"{checkpoint.rstrip('/')}_batches"

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        sorted_out = triage(batch)
        sorted_out.write.parquet(f"{aside}/{name}")
        copy = spark.read.schema(sorted_out.schema).parquet(f"{aside}/{name}")
        batch_folders(dead_letters)(copy.where("reason is not null"), batch_id)
        there = f"{events}/batch={batch_id}"
        if "_SUCCESS" not in Folder(spark, there).names():  # else downstream may have read its files
            copy.where("reason is null").select("key", "value").write.mode("overwrite").parquet(there)
        Folder(spark, aside).remove(name)

    return _each_batch(messages, "append", checkpoint, write, trigger)


# Sinks ------------------------------------------------------------------------

def append_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 mode: str = "append", trigger: Mapping | None = None) -> StreamingQuery:
    """Closed results to files (S15); only append is valid for file sinks."""
    return (df.writeStream.format(fmt).outputMode(mode).option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
            .start())


def console(df: DataFrame, mode: str = "update", trigger: Mapping | None = None,
            checkpoint: str | None = None) -> StreamingQuery:
    """Live preview."""
    w = df.writeStream.format("console").outputMode(mode).option("truncate", "false")
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def batch_folders(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """foreachBatch writer of rows without ids: each micro-batch overwrites its own
    ``batch_id=N`` partition, so replaying a batch after a failure rewrites it
    instead of appending twice."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").format(fmt).save(path))
    return write


def append_batches(df: DataFrame, path: str, checkpoint: str,
                   trigger: Mapping | None = None) -> StreamingQuery:
    """Closed windows appended without document ids."""
    return _each_batch(df, "append", checkpoint, batch_folders(path), trigger)


def _each_batch(df: DataFrame, mode: str, checkpoint: str, write: Callable[[DataFrame, int], None],
                trigger: Mapping | None) -> StreamingQuery:
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**(trigger or {"availableNow": True})).start())


def upsert(df: DataFrame, path: str, checkpoint: str, mode: str = "update",
           trigger: Mapping | None = None, order: Sequence[str] = ("window_end", "batch_id")) -> StreamingQuery:
    """Keyed upsert sink (S14, ST12): ``df`` must carry ``doc_id``. The folder is a
    ``DocumentStore``."""
    return _each_batch(df, mode, checkpoint, DocumentStore(df.sparkSession, path, order).merge, trigger)


def latest_documents(spark: SparkSession, path: str, order: Sequence[str] = ("window_end", "batch_id"),
                     key: str = "doc_id") -> DataFrame:
    """Current value per document of an upsert folder: greatest (window end, batch id)."""
    found = DocumentStore(spark, path, order, key).read()
    if found is None:
        raise ValueError(f"no batch has been committed to {path}")
    return found


def index_writer(fmt: str, options: Mapping[str, str] | None, id_option: str | None) -> Callable[[DataFrame, int], None]:
    given = {**(options or {}), **({id_option: "doc_id"} if id_option else {})}

    def write(batch: DataFrame, _: int) -> None:
        batch.write.format(fmt).options(**given).mode("append").save()
    return write


def index(df: DataFrame, checkpoint: str, fmt: str, options: Mapping[str, str] | None = None,
          id_option: str | None = None, mode: str = "update", trigger: Mapping | None = None) -> StreamingQuery:
    """Stream results to a search index or any other batch connector (S13,
    S14): each micro-batch is written by ``fmt`` and its ``options`` (nodes,
    credentials, resource). A ledger beside the checkpoint (``<checkpoint>_ledger``) names the batches whose write
    has returned; one that Spark replays is not written again. Only a failure
    between the connector's last row and the ledger's commit can repeat rows: with ``id_option`` (the
    connector's option that names the id column) they are upserted by ``doc_id`` and
    even that changes nothing."""
    ledger = Versions(df.sparkSession, f"{checkpoint.rstrip('/')}_ledger")
    return _each_batch(df, mode, checkpoint, once(ledger, index_writer(fmt, options, id_option)), trigger)


def once(ledger: Versions, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """``write`` for batches that the ledger does not name, which it names then."""
    def guarded(batch: DataFrame, batch_id: int) -> None:
        if batch_id > ledger.last():
            write(batch, batch_id)
            ledger.commit(batch_id)
        else:
            compute(batch)
    return guarded


def save_all(df: DataFrame, root: str, keys: Sequence[str], doc_id: Callable[[DataFrame], DataFrame] | None = None,
             preview: bool = False, trigger: Mapping | None = None, index_format: str | None = None,
             index_options: Mapping[str, str] | None = None, id_option: str | None = None) -> list[StreamingQuery]:
    """The reference's three sinks on one result (ST14), from one query: source,
    join and state are computed once. ``keys`` are the result's group columns beside the window.

    The query runs in update mode. Each micro-batch is written to the shared folder once and then
    goes to every sink: the optional preview, the history of closed windows
    (``<root>/history``), and the documents: running values by id where ``doc_id`` adds that
    column, else closed windows; into a connector if
    ``index_format`` is given, else into ``<root>/documents``. Each sink has its own commit record for
    a batch, so after a failure between two sinks the replayed batch reaches only those it had not reached."""
    spark, checkpoint = df.sparkSession, f"{root}/checkpoints/results"
    windows = WindowHistory(spark, f"{root}/history", f"{root}/_open", keys)
    if index_format:
        ledger = Versions(spark, f"{root}/checkpoints/index_ledger")
        documents = once(ledger, index_writer(index_format, index_options, id_option if doc_id else None))
    elif doc_id:
        documents = DocumentStore(spark, f"{root}/documents").merge
    else:
        documents = batch_folders(f"{root}/documents")

    def write(batch: DataFrame, batch_id: int) -> None:
        aside = f"{root}/_batches"
        name = f"batch-{batch_id}-{uuid.uuid4().hex[:8]}"
        batch.write.parquet(f"{aside}/{name}")
        updates = spark.read.schema(batch.schema).parquet(f"{aside}/{name}")
        if preview:
            zones.preview(flatten_window(updates.orderBy("window", *keys)))
        closed = windows.advance(updates, batch_id, batch_watermark(spark, checkpoint, batch_id))
        documents(doc_id(updates) if doc_id else closed, batch_id)
        Folder(spark, aside).remove(name)

    return [_each_batch(df, "update", checkpoint, write, trigger)]


def run_all(queries: list[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait until all queries have ended (ST14). The first failure, in
    whichever of them, stops the others and is raised."""
    waiting = list(queries)
    try:
        while waiting:
            for query in waiting:
                query.awaitTermination(poll_seconds)  # raises the query's failure
            waiting = [q for q in waiting if q.isActive]
    except Exception:
        for query in queries:
            if query.isActive:
                query.stop()
        raise
