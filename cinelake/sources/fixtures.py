"""Logical review-lake tables derived from the driver's TPC-H-style tables.

The reference ships no data; these views give its tables (FIXTURES.md) the
same shape and null patterns. Each reader scans only the parquet columns it
uses, so Catalyst prunes the scan and pushes filters to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions.expressions import parse_money
from cinelake.sources.schemas import DRIVER


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table; known tables use their declared schema."""
    reader = spark.read.schema(DRIVER[name]) if name in DRIVER else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# The movies view as SQL expressions over ``part``: one projection parsed in
# the JVM. Three separator styles so every list splitter meets blanks.
_MOVIE_SQL = (
    "p_partkey AS movie_id",
    "p_name AS title",
    "concat(p_type, sep, replace(p_name, ' ', sep)) AS genre",
    "CASE WHEN p_partkey % 17 <> 0 THEN concat(p_brand, sep, p_type) END AS writer",
    "CASE WHEN p_partkey % 19 <> 0 THEN concat('Dir ', CAST(p_partkey % 40 AS STRING), sep, "
    "'Dir ', CAST(40 + p_partkey % 7 AS STRING)) END AS director",
    "CASE p_partkey % 3 WHEN 0 THEN 'English' WHEN 1 THEN 'French' END AS originalLanguage",
    "CASE WHEN p_partkey % 13 <> 0 THEN make_date(CAST(1965 + p_partkey % 60 AS INT), 1, 1) END "
    "AS releaseDateTheaters",
    "concat('$', CAST(p_size AS STRING), '.5', "
    "CASE p_partkey % 4 WHEN 0 THEN 'K' WHEN 1 THEN 'M' WHEN 2 THEN 'B' END) AS boxOffice",
    "CASE WHEN p_partkey % 7 <> 0 THEN p_size * 2 END AS audienceScore",
    "CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_partkey % 101 AS INT) END AS tomatoMeter",
    "CASE WHEN p_partkey % 10 <> 0 THEN CAST(p_partkey AS INT) END AS imdb_id",
)
_SEP_SQL = "CASE p_partkey % 3 WHEN 0 THEN ',' WHEN 1 THEN ', ' ELSE ' , ' END AS sep"


def movies(spark: SparkSession, sf_dir: str, parse_box_office: bool = True) -> DataFrame:
    """Transform-zone movies: one row per film, packed genre/writer/director
    lists, box office parsed to a number (as the conform job leaves it)."""
    films = table(spark, sf_dir, "part").selectExpr("*", _SEP_SQL).selectExpr(*_MOVIE_SQL)
    if parse_box_office:
        films = films.withColumn("boxOffice", parse_money("boxOffice"))
    return films


def reviews(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Transform-zone reviews: one row per review (lineitem), year of the
    order as ``creationDate``.

    ``years=(lo, hi)`` keeps lo <= year < hi and is applied to the order date
    itself, so it reaches the parquet scan as a pushed range filter (the role
    partition pruning plays on the year-partitioned zone table).
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    if years is not None:
        lo, hi = years
        orders = orders.filter(
            (F.col("o_orderdate") >= F.lit(f"{lo}-01-01").cast("timestamp_ntz"))
            & (F.col("o_orderdate") < F.lit(f"{hi}-01-01").cast("timestamp_ntz"))
        )
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey AS movie_id",
        "CAST(year(o_orderdate) AS INT) AS creationDate",
        "CASE WHEN l_linenumber <> 7 THEN l_linestatus = 'F' END AS isTopCritic",
        "CASE l_returnflag WHEN 'N' THEN 'NEGATIVE' ELSE 'POSITIVE' END AS scoreSentiment",
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-zone reviews, all columns in an order of their own: 'A' return
    flags carry no sentiment (to be imputed); texts hold quotes and commas."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey)
    return joined.selectExpr(
        "CASE l_returnflag WHEN 'N' THEN 'NEGATIVE' WHEN 'R' THEN 'POSITIVE' END AS scoreSentiment",
        "concat('He said \"fine, film ', CAST(l_partkey AS STRING), '\"') AS reviewText",
        "CAST(l_partkey AS STRING) AS id",
        "'The Paper, daily' AS publicatioName",
        "CAST(o_orderdate AS DATE) AS creationDate",
        "CASE WHEN l_linenumber <> 7 THEN l_linestatus = 'F' END AS isTopCritic",
        "concat('Critic ', CAST(l_linenumber AS STRING)) AS criticName",
        "concat('http://reviews.example/', CAST(l_orderkey AS STRING)) AS reviewUrl",
        "concat(CAST(l_linenumber AS STRING), '/10') AS originalScore",
        "CASE l_linestatus WHEN 'F' THEN 'fresh' ELSE 'rotten' END AS reviewState",
        "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS reviewId",
    )


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-zone movies, all columns in an order of their own: unique titles,
    box office as text, four columns that the conform job drops."""
    films = movies(spark, sf_dir, parse_box_office=False)
    return films.selectExpr(
        "concat('$PG-', CAST(movie_id % 18 AS STRING)) AS rating", "CAST(movie_id AS STRING) AS id",
        "boxOffice", "audienceScore", "tomatoMeter", "concat('Title ', CAST(movie_id AS STRING)) AS title",
        "\"['mild', 'loud']\" AS ratingContents", "releaseDateTheaters", "genre", "originalLanguage", "director",
        "writer", "concat('House ', CAST(movie_id % 9 AS STRING), ', Ltd') AS distributor", "'Dolby, 5.1' AS soundMix",
    )


def mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """title -> tmdb movie id; two thirds of the ids are not known, every
    30th title appears twice."""
    key = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey")
    ids = F.when(key % 30 == 0, F.array(F.lit(100000) + key, F.lit(200000) + key)) \
        .when(key % 3 == 0, F.array(F.lit(100000) + key)).otherwise(F.array(F.lit(None).cast("long")))
    return part.select(F.concat(F.lit("Title "), _s(key)).alias("title"), F.explode(ids).alias("movie_id"))


def imdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """imdb titles "tt0000001"; a quarter of the ids are not known."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.when(key % 4 != 0, F.concat(F.lit("tt"), F.lpad(_s(key), 7, "0"))).alias("id"),
        F.concat(F.lit("Title "), _s(key)).alias("name"),
    )


def _film_key(props: Column) -> Column:
    return F.regexp_extract(props, "[0-9]+", 0).cast("int")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User ratings (stream input before flattening); error events unrated."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("int").alias("userId"),
        _film_key(F.col("props")).alias("movieId"),
        F.when(F.col("event_type") != "error", (F.col("event_id") % 11).cast("double") / 2).alias("rating"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Film ids; every 11th film has no external ids."""
    key = F.col("p_partkey")
    known = key % 11 != 0
    return table(spark, sf_dir, "part").select(
        key.cast("int").alias("movieId"),
        F.when(known, (F.lit(100000) + key).cast("int")).alias("tmdbId"),
        F.when(known, key.cast("int")).alias("imdbId"),
    )


def stream_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.col("p_name").alias("title"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("|")).alias("genres"),
    )


def stream_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review events as the producer sends them (one row per message)."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract(F.col("props"), "[0-9]+", 0)
    return ev.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("int").alias("userId"),
        k.cast("int").alias("movieId"),
        k.cast("int").alias("imdbId"),
        F.concat(F.lit("Film "), k).alias("title"),
        F.when(F.col("event_type") != "error", (F.col("event_id") % 11).cast("double") / 2).alias("rating"),
    )


def flawed_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw movies with values that their declared types cannot hold: numbers in words,
    fractions that are no number, dates of no calendar. Blank and missing values are no such values."""
    key = F.col("id").cast("long")
    return raw_movies(spark, sf_dir).withColumns({
        "audienceScore": F.when(key % 9 == 0, F.lit("n/a")).when(key % 9 == 1, F.lit(" "))
                          .otherwise(_s(F.col("audienceScore"))),
        "tomatoMeter": F.when(key % 12 == 0, F.lit("9 of 10")).otherwise(_s(F.col("tomatoMeter"))),
        "releaseDateTheaters": F.when(key % 15 == 0, F.lit("2020-02-31")).otherwise(_s(F.col("releaseDateTheaters"))),
    })
