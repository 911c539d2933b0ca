"""Declared schemas for every zone table (no schema inference pass)."""

from pyspark.sql.types import (
    BinaryType,
    TimestampNTZType,
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Driver tables (the columns we read). Declared so a scan needs no footer
# inference pass; extra columns in the files are simply not read.

DRIVER = {
    "part": _schema(("p_partkey", LongType()), ("p_name", StringType()), ("p_brand", StringType()),
                    ("p_type", StringType()), ("p_size", IntegerType())),
    "lineitem": _schema(("l_orderkey", LongType()), ("l_partkey", LongType()),
                        ("l_linenumber", IntegerType()), ("l_returnflag", StringType()),
                        ("l_linestatus", StringType())),
    "orders": _schema(("o_orderkey", LongType()), ("o_orderdate", TimestampNTZType())),
    "events": _schema(("event_id", LongType()), ("ts", TimestampNTZType()), ("user_id", LongType()),
                      ("event_type", StringType()), ("props", StringType())),
}

# Raw zone -------------------------------------------------------------------

# Column names of the raw files (the spelling is theirs). Raw ids
# are text. Text columns that the clean and conform jobs drop are declared too.
RAW_MOVIES = _schema(
    ("id", StringType()), ("title", StringType()), ("genre", StringType()), ("director", StringType()),
    ("writer", StringType()), ("originalLanguage", StringType()), ("releaseDateTheaters", DateType()),
    ("boxOffice", StringType()), ("audienceScore", IntegerType()), ("tomatoMeter", IntegerType()),
    ("rating", StringType()), ("ratingContents", StringType()), ("distributor", StringType()),
    ("soundMix", StringType()),
)

RAW_REVIEWS = _schema(
    ("id", StringType()), ("reviewId", StringType()), ("creationDate", DateType()),
    ("criticName", StringType()), ("isTopCritic", BooleanType()), ("originalScore", StringType()),
    ("reviewState", StringType()), ("publicatioName", StringType()), ("reviewText", StringType()),
    ("scoreSentiment", StringType()), ("reviewUrl", StringType()),
)

MAPPER = _schema(("title", StringType()), ("movie_id", LongType()))

IMDB = _schema(("id", StringType()), ("name", StringType()))

LINKS = _schema(("movieId", IntegerType()), ("tmdbId", IntegerType()), ("imdbId", IntegerType()))

RATINGS = _schema(
    ("userId", IntegerType()), ("movieId", IntegerType()), ("rating", DoubleType()),
    ("timestamp", TimestampType()),
)

STREAM_MOVIES = _schema(("movieId", IntegerType()), ("title", StringType()), ("genres", StringType()))

# The replay file: ratings joined to links and stream movies.
STREAM_FLAT = _schema(
    ("userId", IntegerType()), ("movieId", IntegerType()), ("rating", DoubleType()), ("title", StringType()),
    ("genres", StringType()), ("tmdbId", IntegerType()), ("imdbId", IntegerType()), ("timestamp", TimestampType()),
)

# Transform zone ---------------------------------------------------------------

MOVIES = _schema(
    ("movie_id", StringType()), ("title", StringType()), ("genre", StringType()),
    ("writer", StringType()), ("director", StringType()), ("originalLanguage", StringType()),
    ("releaseDateTheaters", DateType()), ("boxOffice", DoubleType()),
    ("audienceScore", IntegerType()), ("tomatoMeter", IntegerType()), ("tmdb_id", LongType()),
    ("imdb_id", IntegerType()),
)

REVIEWS = _schema(
    ("movie_id", StringType()), ("reviewId", StringType()), ("creationDate", IntegerType()),
    ("isTopCritic", BooleanType()), ("originalScore", FloatType()), ("scoreSentiment", StringType()),
)

# Stream messages --------------------------------------------------------------

# Key/value frame as a message broker (or its file stand-in) carries it.
MESSAGE = _schema(("key", BinaryType()), ("value", BinaryType()))

# JSON payload of one review message. Every stream query decodes the same
# schema and uses the fields it needs.
REVIEW_EVENT = _schema(
    ("userId", IntegerType()), ("movieId", IntegerType()), ("rating", FloatType()),
    ("title", StringType()), ("genres", StringType()), ("tmdbId", IntegerType()),
    ("imdbId", IntegerType()), ("timestamp", TimestampType()),
)
