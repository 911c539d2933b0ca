"""Replay review events through a topic and run a windowed question on it.

This is the harness of the registered stream queries, not part of the engine:
it encodes review events as keyed JSON and publishes them (the producer's
known-film filter is ``prep.known_film_reviews``, in the publish job). A run publishes one slice of events and
drains the topic with an ``availableNow`` trigger on a fixed checkpoint, so
successive slices behave like data arriving between restarts (restart,
late-data (ST9) and upsert checks use several slices).
"""

from __future__ import annotations

import contextlib
import io as text
import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import fresh_path
from cinelake.sources import fixtures as fx
from cinelake.streaming import io
from cinelake.streaming.messages import PAYLOAD_FIELDS, decode, encode
from cinelake.streaming.windows import EVENT_TIME, flatten_window, with_doc_id

#: Seconds spent publishing so far (the bench reports them apart).
PUBLISH_SECONDS = [0.0]

Builder = Callable[[DataFrame, DataFrame], DataFrame]


def review_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review events of the driver tables encoded as topic messages."""
    return encode(fx.stream_reviews(spark, sf_dir))


def halves(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """Event-time split at the midpoint of the replayed period (one small
    aggregate: two timestamps reach the driver)."""
    events = fx.stream_reviews(spark, sf_dir)
    row = events.agg(F.min(EVENT_TIME).alias("lo"), F.max(EVENT_TIME).alias("hi")).first()
    mid = row.lo + (row.hi - row.lo) / 2
    ts = F.col(EVENT_TIME)
    return ts < F.lit(mid), ts >= F.lit(mid)


class Replay:
    """One topic, one checkpoint, one output folder under the work folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str):
        self.spark, self.sf_dir = spark, sf_dir
        base = fresh_path(spark, name)
        self.topic = io.Topic(f"{base}/topic")
        self.out, self.checkpoint = f"{base}/out", f"{base}/checkpoint"
        self.movies = fx.movies(spark, sf_dir)
        self.progress: list[dict] = []
        self.publish_seconds = 0.0

    def publish(self, where: Column | None = None) -> None:
        events = fx.stream_reviews(self.spark, self.sf_dir)
        rows = events if where is None else events.filter(where)
        began = time.perf_counter()
        io.publish(encode(rows, partitions=self.spark.sparkContext.defaultParallelism), self.topic)
        self.publish_seconds += time.perf_counter() - began
        PUBLISH_SECONDS[0] += time.perf_counter() - began

    def events(self) -> DataFrame:
        return decode(io.subscribe(self.spark, self.topic))

    def drain(self, build: Builder, sink: str = "append", doc_id: str | None = None) -> None:
        """Run the question over everything new in the topic, then stop."""
        result = build(self.events(), self.movies)
        if sink == "append":
            q = io.append_files(result, self.out, self.checkpoint)
        else:
            q = io.upsert(with_doc_id(result, doc_id), self.out, self.checkpoint)
        io.run_all([q])
        self.progress.extend(p for p in q.recentProgress)

    def dropped_late_rows(self) -> int:
        return sum(op.get("numRowsDroppedByWatermark", 0)
                   for p in self.progress for op in p.get("stateOperators", []))


def run_windowed(spark: SparkSession, sf_dir: str, build: Builder, name: str,
                 slices: Sequence[Column | None] = (None,)) -> DataFrame:
    """Publish each slice and drain it into an append parquet sink; return
    the closed windows written, window flattened to start/end columns."""
    replay = Replay(spark, sf_dir, name)
    for where in slices:
        replay.publish(where)
        replay.drain(build)
    return flatten_window(spark.read.parquet(replay.out))


def run_upserted(spark: SparkSession, sf_dir: str, build: Builder, doc_id: str, name: str,
                 slices: Sequence[Column | None] = (None,)) -> DataFrame:
    """Same with the keyed upsert sink; returns the latest row per doc_id."""
    replay = Replay(spark, sf_dir, name)
    for where in slices:
        replay.publish(where)
        replay.drain(build, sink="upsert", doc_id=doc_id)
    latest = io.latest_documents(spark, replay.out)
    return flatten_window(latest.drop("batch_id", "window_end"))


def run_sinks(spark: SparkSession, sf_dir: str, build: Builder, doc_id: str, name: str) -> DataFrame:
    """All sinks of one result at once (ST14): rows of the append history and
    the latest documents, marked by ``sink``."""
    replay = Replay(spark, sf_dir, name)
    replay.publish()
    result = build(replay.events(), replay.movies)
    io.run_all(io.save_all(result, replay.out, [doc_id], lambda df: with_doc_id(df, doc_id)))
    history = spark.read.parquet(f"{replay.out}/history").drop("batch_id").withColumn("sink", F.lit("history"))
    latest = io.latest_documents(spark, f"{replay.out}/documents").drop("batch_id", "window_end", "doc_id")
    return flatten_window(history.unionByName(latest.withColumn("sink", F.lit("documents"))))


def run_appended(spark: SparkSession, sf_dir: str, build: Builder, name: str) -> DataFrame:
    """Closed windows through the batch-wise append sink (S13), whose batches
    replace their own rows when they are replayed."""
    replay = Replay(spark, sf_dir, name)
    replay.publish()
    io.run_all([io.append_batches(build(replay.events(), replay.movies), replay.out, replay.checkpoint)])
    return flatten_window(spark.read.parquet(replay.out).drop("batch_id"))


def run_live_state(spark: SparkSession, sf_dir: str, build: Builder, name: str,
                   slices: Sequence[Column | None] = (None,)) -> DataFrame:
    """Publish and drain the slices; what the state store then holds (ST9): one row
    a live group, keys and values flattened."""
    replay = Replay(spark, sf_dir, name)
    for where in slices:
        replay.publish(where)
        replay.drain(build)
    state = spark.read.format("statestore").load(replay.checkpoint)
    return flatten_window(state.select("key.*", "value.*"))


def flawed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review events as messages, every 50th cut off, the next one with a time that
    cannot be read, the one after without a time."""
    events = fx.stream_reviews(spark, sf_dir)
    turn = F.col("event_id") % 50
    text = F.col("value").cast("string")
    cut = encode(events.where(turn == 0)).withColumn("value", F.encode(F.substring(text, 1, 20), "UTF-8"))
    soon = encode(events.where(turn == 1)).withColumn(
        "value", F.encode(F.regexp_replace(text, '"timestamp":"[^"]*"', '"timestamp":"soon"'), "UTF-8"))
    timeless = encode(events.where(turn == 2), fields=[f for f in PAYLOAD_FIELDS if f != EVENT_TIME])
    return encode(events.where(turn > 2)).unionByName(cut).unionByName(soon).unionByName(timeless)


def run_diverted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Messages by what became of them: dead letters by reason, events by the topic they went on to."""
    replay = Replay(spark, sf_dir, name)
    io.publish(flawed_messages(spark, sf_dir), replay.topic)
    events, dead = f"{replay.out}/events", f"{replay.out}/dead"
    io.run_all([io.divert(io.subscribe(spark, replay.topic), events, dead, replay.checkpoint)])
    passed = decode(spark.read.option("recursiveFileLookup", "true").parquet(events)).where(F.col(EVENT_TIME).isNotNull())
    return spark.read.parquet(dead).groupBy("reason").agg(F.count(F.lit(1)).alias("messages")).unionByName(
        passed.agg(F.lit("event").alias("reason"), F.count(F.lit(1)).alias("messages")))


def printed(text: str, columns: Sequence[str]) -> list[tuple[str, ...]]:
    """Cells of printed tables, headers and borders left out."""
    rows = [tuple(cell.strip() for cell in line.strip("|").split("|")) for line in text.splitlines() if line.startswith("|")]
    return [r for r in rows if r != tuple(columns)]


def run_previewed(spark: SparkSession, sf_dir: str, build: Builder, keys: Sequence[str], name: str) -> DataFrame:
    """What the preview sink of a stream has printed (S12), as text columns."""
    replay = Replay(spark, sf_dir, name)
    replay.publish()
    result = build(replay.events(), replay.movies)
    columns = flatten_window(result).columns
    with contextlib.redirect_stdout(text.StringIO()) as shown:
        io.run_all(io.save_all(result, replay.out, keys, preview=True))
    return spark.createDataFrame(printed(shown.getvalue(), columns), ", ".join(f"{c} string" for c in columns))
