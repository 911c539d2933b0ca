"""Registry of runnable queries: key -> (spark, sf_dir) -> DataFrame.

Each entry reads the driver tables through ``sources.fixtures`` and applies
one plan; thresholds come from ``params``. ``BATCH_PLANS`` holds the batch
questions as functions of (movies, reviews) so the same plans also run on
a written transform zone (``write_zone``), as a deployment's jobs do.
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake import params as P
from cinelake import replay
from cinelake.plans import batch, curated, prep, sketches
from cinelake.session import fresh_path, tune
from cinelake.sources import fixtures as fx
from cinelake.sources import schemas, zones
from cinelake.streaming import messages, windows

Query = Callable[[SparkSession, str], DataFrame]

_CERT = dict(min_ratio=P.CERTIFIED_RATIO, min_top_critics=P.CERTIFIED_MIN_TOP_CRITICS,
             min_positive=P.CERTIFIED_MIN_POSITIVE)


def _mr(spark: SparkSession, d: str, **kw):
    tune(spark)
    return fx.movies(spark, d), fx.reviews(spark, d, **kw)


Plan = Callable[[DataFrame, DataFrame], DataFrame]

# Batch questions as functions of the transform-zone frames (movies, reviews):
# the registered queries feed them the fixture views, a deployment (and the
# bench's zone pass) feeds them the written zone tables.
BATCH_PLANS: dict[str, Plan] = {
    "b01_top_genre_per_year": batch.top_genre_per_year,
    "b02_rotten_genres": batch.rotten_genres,
    "b02_rotten_genres_share": lambda m, r: batch.rotten_genres_share(m, r, negative_share=P.NEGATIVE_SHARE),
    "b03_writer_box_office": lambda m, r: batch.writer_box_office(m),
    "b04_certified_writer_genres": lambda m, r: batch.certified_writer_genres(m, r, **_CERT),
    "b05_directors_in_years": lambda m, r: batch.directors_in_years(
        m, r, first_year=P.YEARS[0], end_year=P.YEARS[1]),
    "b06_top_reviewed": lambda m, r: batch.top_reviewed(m, r, min_reviews=P.MIN_POSITIVE_REVIEWS),
    "b06_top_share": lambda m, r: batch.top_share(m, r, min_reviews=P.MIN_POSITIVE_REVIEWS),
    "b07_genre_scores": lambda m, r: batch.genre_scores(m, min_films=P.MIN_GENRE_FILMS),
    "b07_genre_scores_clean": lambda m, r: batch.genre_scores(m, min_films=P.MIN_GENRE_FILMS,
                                                              split_mode="clean"),
    "b08_certified_films": lambda m, r: batch.certified_films(m, r, **_CERT),
    "b08_certified_titles": lambda m, r: batch.certified_titles(m, r, **_CERT),
    "b09_writer_positive": lambda m, r: batch.writer_top(batch.writer_sentiment(m, r), "POSITIVE"),
    "b09_writer_negative": lambda m, r: batch.writer_top(batch.writer_sentiment(m, r), "NEGATIVE"),
    "b10_release_buckets": batch.release_buckets,
}

# Review columns each plan may read (the zone table keeps no lineitem keys).
REVIEW_COLUMNS = ("movie_id", "creationDate", "isTopCritic", "scoreSentiment")


def _from_views(key: str) -> Query:
    plan = BATCH_PLANS[key]
    # B5's year range is also applied to the order date so it reaches the scan.
    kw = {"years": P.YEARS} if key == "b05_directors_in_years" else {}
    return lambda spark, d: plan(*_mr(spark, d, **kw))


BATCH: dict[str, Query] = {key: _from_views(key) for key in BATCH_PLANS}


def write_zone(spark: SparkSession, d: str, root: str) -> tuple[str, str]:
    """Materialise the transform zone from the views: films, and reviews
    partitioned by year (what E2/E3 leave for the batch jobs)."""
    tune(spark)
    movies, reviews = f"{root}/movies", f"{root}/reviews"
    zones.write_table(fx.movies(spark, d), movies)
    zones.write_table(fx.reviews(spark, d).select(*REVIEW_COLUMNS), reviews, partition_by=["creationDate"])
    return movies, reviews


def _sketched(spark: SparkSession, d: str) -> DataFrame:
    """B2 from a written table of sketches alone."""
    path = fresh_path(spark, "sketches")
    sketches.write_rotten_sketches(*_mr(spark, d), path)
    return sketches.rotten_genres(spark.read.parquet(path))


BATCH["b02_rotten_genres_sketch"] = _sketched


# Raw tables: fixture view, declared schema.
RAW = {
    "movies": (fx.raw_movies, schemas.RAW_MOVIES), "reviews": (fx.raw_reviews, schemas.RAW_REVIEWS),
    "mapper": (fx.mapper, schemas.MAPPER), "movies_imdb": (fx.imdb, schemas.IMDB),
    "links": (fx.links, schemas.LINKS), "ratings": (fx.ratings, schemas.RATINGS),
}


def _land(spark: SparkSession, d: str, *names: str) -> str:
    """Land raw tables as CSV in a new raw zone; returns its root."""
    tune(spark)
    root = fresh_path(spark, "raw")
    zones.land({n: RAW[n][0](spark, d) for n in names}, root, "csv")
    return root


def _landed(name: str) -> Query:
    def run(spark, d):
        table = zones.read_table(spark, f"{_land(spark, d, name)}/{name}", "csv", RAW[name][1])
        times = [f.name for f in table.schema if f.dataType.typeName() == "timestamp"]
        return table.withColumns({c: table[c].cast("timestamp_ntz") for c in times})
    return run


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    """E2 as the job runs it: raw CSV, transform zone, read back."""
    out = fresh_path(spark, "reviews-clean")
    prep.run_clean_reviews(spark, f"{_land(spark, d, 'reviews')}/reviews", out)
    return zones.read_table(spark, out)


def _conformed(spark: SparkSession, d: str) -> DataFrame:
    """E3 as the job runs it: raw CSV tables, transform zone, read back."""
    out = fresh_path(spark, "movies-conformed")
    prep.run_conform_movies(spark, _land(spark, d, "movies", "mapper", "movies_imdb"), out)
    return zones.read_table(spark, out)


def _coverage(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return prep.id_coverage(prep.conform_movies(fx.raw_movies(spark, d), fx.mapper(spark, d), fx.imdb(spark, d)))


def _chain(key: str) -> Query:
    """Land, clean, conform, then a batch question from the written zone."""
    return lambda spark, d: BATCH_PLANS[key](_conformed(spark, d), _cleaned(spark, d))


def _flat(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    flat = prep.flatten_stream_input(fx.ratings(spark, d), fx.links(spark, d), fx.stream_movies(spark, d))
    return flat.withColumn("timestamp", flat["timestamp"].cast("timestamp_ntz"))


def _replayed(spark: SparkSession, d: str) -> DataFrame:
    known = prep.known_film_reviews(_flat(spark, d), fx.movies(spark, d))
    decoded = messages.decode(messages.encode(known), keep_key=True)
    return decoded.withColumn("timestamp", decoded["timestamp"].cast("timestamp_ntz"))


def _sent_now(spark: SparkSession, d: str) -> DataFrame:
    """Messages stamped with the send time (F18), without that time: the rest
    of the key and the payload."""
    decoded = messages.decode(messages.encode(_flat(spark, d), stamp_send_time=True), keep_key=True)
    parts = F.split("key", "_")
    return decoded.withColumn("key", F.concat_ws("_", parts[0], parts[1])) \
        .withColumn("stamped", F.col("timestamp").isNotNull()).drop("timestamp")


def _zone_years(spark: SparkSession, d: str) -> DataFrame:
    """E2 written to a year-partitioned zone (S7), read back with a year
    range that prunes partition directories (S3)."""
    tune(spark)
    path = fresh_path(spark, "reviews-zone")
    zones.write_table(prep.clean_reviews(fx.raw_reviews(spark, d)), path, partition_by=["creationDate"])
    lo, hi = P.YEARS
    zone = zones.read_table(spark, path)
    picked = zone.filter((F.col("creationDate") >= lo) & (F.col("creationDate") < hi))
    return picked.groupBy("creationDate", "scoreSentiment").agg(F.count(F.lit(1)).alias("reviews"))


def _rejected(spark: SparkSession, d: str) -> DataFrame:
    """The quarantine that the E3 job leaves beside the zone."""
    root = _land(spark, d, "mapper", "movies_imdb")
    zones.land({"movies": fx.flawed_movies(spark, d)}, root, "csv")
    prep.run_conform_movies(spark, root, f"{root}-zone", quarantine=f"{root}-quarantine")
    return zones.read_table(spark, f"{root}-quarantine").select(
        F.get_json_object("row", "$.id").alias("id"), "column", "value")


ETL: dict[str, Query] = {
    "e01_land_raw_movies": _landed("movies"),
    **{f"e01_land_raw_{name}": _landed(name) for name in RAW if name != "movies"},
    "e02_reviews_clean": _cleaned,
    "e03_movies_conformed": _conformed,
    "e04_id_coverage": _coverage,
    "e05_stream_flat": _flat,
    "e06_replay_messages": _replayed,
    "e07_reviews_zone_years": _zone_years,
    "e08_chain_top_genre_per_year": _chain("b01_top_genre_per_year"),
    "e09_chain_certified_titles": _chain("b08_certified_titles"),
    "e10_send_time_messages": _sent_now,
    "e11_rejected_values": _rejected,
}


def _curated(spark: SparkSession, d: str) -> DataFrame:
    """A batch result as curated JSON (S8), read back."""
    root = fresh_path(spark, "curated")
    curated.publish_result(BATCH["b01_top_genre_per_year"](spark, d), "q", root)
    return spark.read.schema("creationDate int, genre string, count long").json(f"{root}/q")


def _two_sinks(spark: SparkSession, d: str) -> DataFrame:
    """One result to JSON and to an index connector (S9, S10; a file format
    stands in for the connector), both read back."""
    root = fresh_path(spark, "two-sinks")
    curated.publish_result(BATCH["b09_writer_positive"](spark, d), "q", root, "parquet", {"path": f"{root}/index"})
    one = spark.read.schema("writer string, POSITIVE long, NEGATIVE long").json(f"{root}/q")
    return one.withColumn("sink", F.lit("json")).unionByName(
        spark.read.parquet(f"{root}/index").withColumn("sink", F.lit("index")))


def _previewed(spark: SparkSession, d: str) -> DataFrame:
    """What the preview of a result prints (S11), as text columns."""
    result = BATCH["b08_certified_titles"](spark, d)
    with contextlib.redirect_stdout(io.StringIO()) as shown:
        zones.preview(result)
    return spark.createDataFrame(replay.printed(shown.getvalue(), result.columns),
                                 ", ".join(f"{c} string" for c in result.columns))


CURATED: dict[str, Query] = {
    "c01_curated_json": _curated,
    "c02_two_sinks": _two_sinks,
    "c03_preview": _previewed,
}


def _stream(build, name: str) -> Query:
    def run(spark, d):
        tune(spark)
        return replay.run_windowed(spark, d, build, name)
    return run


def _late(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    first, second = replay.halves(spark, d)
    return replay.run_windowed(spark, d, lambda ev, mv: windows.film_counts(ev), "t07",
                               slices=(first, second, first))


def _upserted(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    first, second = replay.halves(spark, d)
    return replay.run_upserted(spark, d, windows.director_counts, "director_name", "t06",
                               slices=(first, second))


def _upsert(build, doc_id: str, name: str) -> Query:
    def run(spark, d):
        tune(spark)
        return replay.run_upserted(spark, d, build, doc_id, name)
    return run


def _appended(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return replay.run_appended(spark, d, windows.director_counts, "t11")


def _sinks(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return replay.run_sinks(spark, d, windows.director_counts, "director_name", "t12")


def _live_state(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    first, second = replay.halves(spark, d)
    return replay.run_live_state(spark, d, lambda ev, mv: windows.film_counts(ev), "t13", slices=(first, second, first))


def _diverted(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return replay.run_diverted(spark, d, "t14")


def _live_preview(spark: SparkSession, d: str) -> DataFrame:
    tune(spark)
    return replay.run_previewed(spark, d, windows.director_counts, ["director_name"], "t15")


STREAM: dict[str, Query] = {
    "t01_film_counts": _stream(lambda ev, mv: windows.film_counts(ev), "t01"),
    "t02_genre_language_rating": _stream(windows.genre_language_rating, "t02"),
    "t03_director_counts": _stream(windows.director_counts, "t03"),
    "t04_writer_ratings": _stream(windows.writer_ratings, "t04"),
    "t05_rating_vs_audience": _stream(windows.rating_vs_audience, "t05"),
    "t06_latest_by_doc": _upserted,
    "t07_late_rows_dropped": _late,
    "t08_latest_by_window_title": _upsert(windows.rating_vs_audience, "window_title", "t08"),
    "t09_latest_by_genre_language": _upsert(windows.genre_language_rating, "genre_language", "t09"),
    "t10_latest_by_writer": _upsert(windows.writer_ratings, "writer_name", "t10"),
    "t11_appended_batches": _appended,
    "t12_three_sinks": _sinks,
    "t13_live_state": _live_state,
    "t14_dead_letters": _diverted,
    "t15_live_preview": _live_preview,
}


def all_queries() -> dict[str, Query]:
    return {**BATCH, **ETL, **CURATED, **STREAM}
