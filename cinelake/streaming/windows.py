"""The five windowed review questions (T1-T5) as DataFrame functions.

Each takes the decoded review events (a stream, or a static frame for
batch-equals-stream checks) and, where needed, the static movie dimension.
The watermark is set on the event-time column before windowing; Spark then
tracks it correctly and closes windows in append mode (a watermark on the
window struct, as the reference sets it, never advances). Joins to the
movies are inner: the reference's left joins are followed by an explode or
a null drop that removes unmatched rows anyway. The reference's watermark
on the window struct (ST3) and its second watermark after the aggregate (ST4)
are deliberately not reproduced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.expressions import language_class, split_list, split_list_or_empty

EVENT_TIME = "timestamp"


# Movie columns any stream question reads.
DIMENSION_COLUMNS = ("imdb_id", "genre", "originalLanguage", "director", "writer", "audienceScore")


def prepare_movies(movies: DataFrame, partitions: int) -> DataFrame:
    """The static film dimension, hash-partitioned and sorted on imdb_id once
    and kept (memory and disk) for the life of a stream.

    Adaptive execution does not run inside micro-batches, so a dimension too
    large to broadcast would otherwise be re-shuffled for every micro-batch's
    sort-merge join. Partitioned like this, only the (small) micro-batch is
    shuffled to meet it. A dimension measured under the broadcast threshold
    is still broadcast. Lost cached blocks are rebuilt from lineage.
    ``partitions`` should equal the stateful shuffle partition count."""
    dim = movies.select(*DIMENSION_COLUMNS).filter(F.col("imdb_id").isNotNull())
    dim = dim.repartition(partitions, "imdb_id").sortWithinPartitions("imdb_id").persist()
    # Load it now: an adaptively planned cache reports its partitioning to
    # later joins once materialised (one count reaches the driver).
    dim.count()
    return dim


@dataclass(frozen=True)
class HotFilms:
    """Films that hold a large share of the events (see ``hot_films``). On
    the join their events are dealt over ``salts`` tasks, and their
    dimension rows, at most 1 / share of them, are repeated as often."""
    ids: tuple[int, ...]
    salts: int = 16


def hot_films(events: DataFrame, share: float = 0.01, salts: int = 16) -> HotFilms:
    """Films with at least ``share`` of a (static) sample of events or of the
    topic's history; at most 1 / share ids reach the driver."""
    counts = events.where(F.col("imdbId").isNotNull()).groupBy("imdbId").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    rows = counts.where(F.col("count") >= max(1, total * share)).orderBy(F.desc("count")).limit(int(1 / share)).collect()
    return HotFilms(tuple(sorted(r["imdbId"] for r in rows)), salts)


def _enrich(events: DataFrame, movies: DataFrame, columns: list[str], hot: HotFilms | None = None) -> DataFrame:
    """Stream-static join on imdbId = imdb_id (J8, ST13). Only the needed
    movie columns are carried; Spark broadcasts the dimension when its
    estimated size is under the threshold, else sort-merge joins (see
    ``prepare_movies`` for a dimension that does not fit). Adaptive execution
    does not split skewed keys in micro-batches: ``hot`` does, by salting."""
    dim = movies.select("imdb_id", *columns).filter(F.col("imdb_id").isNotNull())
    if hot is None or not hot.ids:
        return events.join(dim, events["imdbId"] == dim["imdb_id"]).drop(dim["imdb_id"])
    salted = events.withColumn("__salt", F.when(
        F.col("imdbId").isin(*hot.ids), F.pmod(F.xxhash64(*events.columns), F.lit(hot.salts)).cast("int")).otherwise(0))
    copies = F.when(F.col("imdb_id").isin(*hot.ids), F.sequence(F.lit(0), F.lit(hot.salts - 1))).otherwise(F.array(F.lit(0)))
    dim = dim.select("*", F.explode(copies).alias("__copy"))
    return salted.join(dim, (salted["imdbId"] == dim["imdb_id"]) & (salted["__salt"] == dim["__copy"])) \
        .drop("__salt", "__copy", "imdb_id")


def film_counts(events: DataFrame, delay: str = "1 minute", size: str = "1 minute",
                slide: str = "30 seconds") -> DataFrame:
    """Reviews per sliding window, film and title (ST2 ST5 ST8 A1)."""
    return (events.withWatermark(EVENT_TIME, delay)
            .groupBy(F.window(EVENT_TIME, size, slide).alias("window"), "movieId", "title")
            .agg(F.count(F.lit(1)).alias("count")))


def genre_language_rating(events: DataFrame, movies: DataFrame, delay: str = "3 minutes",
                          size: str = "3 minutes", hot: HotFilms | None = None) -> DataFrame:
    """Average rating per tumbling window, genre and English/Non-English
    (ST6 J8 F3 F9 P14 A14)."""
    joined = _enrich(events.withWatermark(EVENT_TIME, delay), movies, ["genre", "originalLanguage"], hot)
    rows = joined.select(
        F.window(EVENT_TIME, size).alias("window"),
        F.explode(split_list("genre", "comma_trim")).alias("genre"),
        language_class("originalLanguage").alias("language"),
        F.col("rating"),
    ).na.drop()
    return rows.groupBy("window", "genre", "language").agg(F.avg("rating").alias("rating"))


def director_counts(events: DataFrame, movies: DataFrame, delay: str = "1 minute",
                    size: str = "1 minute", hot: HotFilms | None = None) -> DataFrame:
    """Reviews per tumbling window and director, names untrimmed (ST6 U5 P14)."""
    joined = _enrich(events.withWatermark(EVENT_TIME, delay), movies, ["director"], hot)
    rows = joined.select(
        F.window(EVENT_TIME, size).alias("window"),
        F.explode(split_list_or_empty("director", "comma")).alias("director_name"),
    ).na.drop()
    return rows.groupBy("window", "director_name").agg(F.count(F.lit(1)).alias("count"))


def writer_ratings(events: DataFrame, movies: DataFrame, delay: str = "2 minutes",
                   size: str = "2 minutes", hot: HotFilms | None = None) -> DataFrame:
    """T4: rated reviews and rounded average rating per window and writer.
    Unrated reviews are kept: they count 0 and do not move the average.
    (ST6 U6 F14 A12 A13 F13)"""
    joined = _enrich(events.withWatermark(EVENT_TIME, delay), movies, ["writer"], hot)
    rows = joined.select(
        F.window(EVENT_TIME, size).alias("window"),
        F.explode(split_list_or_empty("writer", "comma")).alias("writer_name"),
        F.col("rating").cast("float").alias("rating"),
    )
    return rows.groupBy("window", "writer_name").agg(
        F.count("rating").alias("review_count"),
        F.round(F.avg("rating"), 2).alias("avg_rating"),
    )


def rating_vs_audience(events: DataFrame, movies: DataFrame, delay: str = "2 minutes",
                       size: str = "2 minutes", slide: str = "30 seconds", hot: HotFilms | None = None) -> DataFrame:
    """T5: stream rating vs audience score (0-100 rescaled to 0-5) per
    sliding window and title; rows with any null are dropped first
    (ST7 F12 P14 A6 A13)."""
    joined = _enrich(events.withWatermark(EVENT_TIME, delay), movies, ["audienceScore"], hot)
    rows = joined.select(
        EVENT_TIME,
        F.col("title"),
        (F.col("audienceScore") / 20.0).alias("rotten_tomatoes_rating"),
        F.col("rating").cast("float").alias("imdb_rating"),
    ).na.drop()  # before each event is expanded into its windows
    return rows.groupBy(F.window(EVENT_TIME, size, slide).alias("window"), "title").agg(
        F.round(F.avg("imdb_rating"), 2).alias("avg_imdb_rating"),
        F.round(F.avg("rotten_tomatoes_rating"), 2).alias("avg_rotten_tomatoes_rating"),
    )


def with_doc_id(df: DataFrame, kind: str) -> DataFrame:
    """Document id of each result row for keyed upserts."""
    if kind == "genre_language":
        return df.withColumn("doc_id", F.concat_ws("_", "genre", "language"))
    if kind == "window_title":
        return df.withColumn("doc_id", F.concat_ws(
            "_", F.col("window.start").cast("string"), F.col("window.end").cast("string"), "title"))
    return df.withColumn("doc_id", F.col(kind))


def flatten_window(df: DataFrame) -> DataFrame:
    """window struct -> window_start, window_end (timestamp without zone)."""
    others = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window.end").cast("timestamp_ntz").alias("window_end"), *others)
