"""Zone ETL jobs (E1-E5) and the producer's data work (ST15).

Each job is a DataFrame function; the ``run_*`` wrappers add the reads and
writes of the zone layout. No Python UDFs: imputation is a deterministic hash
choice, money parsing and year bucketing are native expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions.expressions import (
    fix_sentiment,
    imdb_number,
    impute_score,
    parse_money,
    year_of,
)
from cinelake.operators.relational import left_join_frequent, semi_join
from cinelake.sources import schemas, zones

# Columns the clean/conform jobs drop (missing names are ignored,
# the reference's own spelling kept).
REVIEW_TEXT_COLUMNS = ("criticName", "reviewText", "reviewUrl", "publicatioName", "reviewState")
MOVIE_EXTRA_COLUMNS = ("rating", "ratingContents", "distributor", "soundMix")

REJECTS = "__rejects"  # values of a raw row that its declared types cannot hold


# E2 -------------------------------------------------------------------------
def clean_reviews(raw: DataFrame, key: str = "reviewId") -> DataFrame:
    """Impute score and repair sentiment (deterministic per ``key``), drop
    review text, keep the review year, ``id`` -> ``movie_id`` (U1 U2 P4 F7 P5).
    Without a ``key`` column the whole row is the key."""
    if key not in raw.columns:
        raw = raw.withColumn("__key", F.to_json(F.struct(*raw.columns)))
        return clean_reviews(raw, "__key").drop("__key")
    out = (raw.withColumn("originalScore", impute_score(F.col(key)))
           .withColumn("scoreSentiment", fix_sentiment("scoreSentiment", F.col(key)))
           .drop(*REVIEW_TEXT_COLUMNS)
           .withColumn("creationDate", year_of("creationDate").cast("int"))
           .withColumnRenamed("id", "movie_id"))
    return out


def run_clean_reviews(spark: SparkSession, raw_path: str, out_path: str, fmt: str = "parquet",
                      extra: str = "error", quarantine: str | None = None) -> int:
    """Raw reviews -> transform zone, partitioned by review year (S7). Returns the
    number of values that no declared type could hold; they go to ``quarantine``."""
    raw = zones.read_table(spark, raw_path, "csv", schemas.RAW_REVIEWS, extra=extra, optional=("reviewId",),
                           rejects=REJECTS)
    raw, rejected, seen = zones.split_rejects(raw, REJECTS)
    zones.write_table(clean_reviews(raw), out_path, fmt, partition_by=["creationDate"])
    return zones.write_quarantine(rejected, seen, quarantine)


# E3 -------------------------------------------------------------------------
def conform_movies(raw: DataFrame, mapper: DataFrame, imdb: DataFrame,
                   suffixes: Sequence[str] = ("K", "M", "B"), missing: float | None = 0.0,
                   dedupe_on_title: bool = False) -> DataFrame:
    """Parse box office, drop unused columns, attach external ids
    (U3 P4 P5 J6 P2 F5).

    Two left joins on the title (J6): the mapper gives ``tmdb_id``, the imdb
    list gives ``imdb_id`` from its "tt..." id. Films are read once, however
    often a list holds a title (``left_join_frequent``). A title listed twice yields
    two rows, as in the reference; ``dedupe_on_title=True`` keeps the
    smallest id per title instead (one aggregate per list, partial before
    its shuffle), so later counts are not multiplied."""
    movies = (raw.withColumnRenamed("id", "movie_id")
              .withColumn("boxOffice", parse_money("boxOffice", suffixes, missing))
              .drop(*MOVIE_EXTRA_COLUMNS))
    ids = mapper.select(F.col("title").alias("__title"), F.col("movie_id").alias("tmdb_id"))
    names = imdb.select(F.col("name").alias("__name"), imdb_number("id").alias("imdb_id"))
    if dedupe_on_title:
        ids = ids.groupBy("__title").agg(F.min("tmdb_id").alias("tmdb_id"))
        names = names.groupBy("__name").agg(F.min("imdb_id").alias("imdb_id"))
        return (movies.join(ids, movies["title"] == ids["__title"], "left").drop("__title")
                .join(names, movies["title"] == names["__name"], "left").drop("__name"))
    return left_join_frequent(left_join_frequent(movies, ids, "title", "__title"), names, "title", "__name")


def run_conform_movies(spark: SparkSession, raw_root: str, out_path: str, fmt: str = "parquet",
                       dedupe_on_title: bool = False, extra: str = "error", quarantine: str | None = None) -> DataFrame:
    """Raw movies + id lists -> transform-zone movies; returns the coverage
    report (E4) computed from the written table, not a second pass. Movie values that no
    declared type can hold go to ``quarantine``."""
    raw = zones.read_table(spark, f"{raw_root}/movies", "csv", schemas.RAW_MOVIES, extra=extra, rejects=REJECTS)
    raw, rejected, seen = zones.split_rejects(raw, REJECTS)
    mapper = zones.read_table(spark, f"{raw_root}/mapper", "csv", schemas.MAPPER, extra="drop")
    imdb = zones.read_table(spark, f"{raw_root}/movies_imdb", "csv", schemas.IMDB, extra="drop")
    zones.write_table(conform_movies(raw, mapper, imdb, dedupe_on_title=dedupe_on_title), out_path, fmt)
    zones.write_quarantine(rejected, seen, quarantine)
    return id_coverage(zones.read_table(spark, out_path, fmt))


# E4 -------------------------------------------------------------------------
def id_coverage(movies: DataFrame) -> DataFrame:
    """Films with at least one external id vs all films, one pass."""
    return movies.agg(
        F.count_if(F.col("imdb_id").isNotNull() | F.col("tmdb_id").isNotNull()).alias("films_with_id"),
        F.count(F.lit(1)).alias("total_films"),
    )


# E5 -------------------------------------------------------------------------
def flatten_stream_input(ratings: DataFrame, links: DataFrame, movies: DataFrame) -> DataFrame:
    """ratings x links x movies on movieId -> the replay rows.

    The two dimension tables are joined first (both one row per film), so
    the large ratings table is shuffled once instead of twice."""
    films = links.select("movieId", "tmdbId", "imdbId").join(
        movies.select("movieId", "title", "genres"), "movieId")
    joined = ratings.join(films, "movieId")
    return joined.select("userId", "movieId", "rating", "title", "genres", "tmdbId", "imdbId",
                         "timestamp")


def run_flatten_stream_input(spark: SparkSession, raw_root: str, out_path: str, fmt: str = "csv") -> None:
    """Raw ratings, links and stream movies -> the replay file (E5)."""
    flat = flatten_stream_input(
        zones.read_table(spark, f"{raw_root}/streaming/ratings", "csv", schemas.RATINGS, extra="drop"),
        zones.read_table(spark, f"{raw_root}/links", "csv", schemas.LINKS, extra="drop"),
        zones.read_table(spark, f"{raw_root}/streaming/movies", "csv", schemas.STREAM_MOVIES, extra="drop"))
    zones.write_table(flat, out_path, fmt)


# ST15 -----------------------------------------------------------------------
def known_film_reviews(flat: DataFrame, movies: DataFrame) -> DataFrame:
    """Keep replay rows whose imdbId is a known film (J9), null-safe like the
    producer's dictionary lookup; a semi join instead of a driver dict."""
    return semi_join(flat, movies, "imdbId", "imdb_id", null_safe=True)
