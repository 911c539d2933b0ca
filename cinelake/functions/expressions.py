"""Column expressions. All are built-in Spark expressions (codegen, no Python
workers); each replaces one of the reference's Python UDFs or inline snippets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's -------------------------------
# List separator normalisation pattern: blanks around a comma collapse.
LIST_SEPARATOR_PATTERN = r"\s*,\s*"
# Score choices used to impute a review score (0 to 5 in half steps).
SCORE_CHOICES = (0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)
# Valid review sentiments; anything else is imputed from these.
SENTIMENTS = ("POSITIVE", "NEGATIVE")
# Money suffix multipliers ("$76.4M").
MONEY_SUFFIXES = {"K": 1e3, "M": 1e6, "B": 1e9}
# Release buckets: five-year spans from 1970-1974 up to 2020-2024, else "Unknown".
BUCKET_FIRST_YEAR, BUCKET_LAST_YEAR, BUCKET_WIDTH = 1970, 2024, 5
UNKNOWN_BUCKET = "Unknown"
# Language class for stream enrichment.
ENGLISH, NON_ENGLISH = "English", "Non-English"

SPLIT_MODES = ("regex", "comma", "comma_space", "comma_trim", "clean")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c, mode: str = "regex") -> Column:
    """Packed list string ("a, b,c") -> array<string>; null stays null.

    Modes reproduce the reference's four ways of splitting:
      regex        blanks around commas removed, then split on ","
      comma        split on "," only (names keep their blanks)
      comma_space  split on ", " only
      comma_trim   split on "," then trim every name
      clean        regex + trim ends + drop empty names
    """
    c = _col(c)
    if mode == "regex":
        return F.split(F.regexp_replace(c, LIST_SEPARATOR_PATTERN, ","), ",")
    if mode == "comma":
        return F.split(c, ",")
    if mode == "comma_space":
        return F.split(c, ", ")
    if mode == "comma_trim":
        return F.transform(F.split(c, ","), lambda x: F.trim(x))
    if mode == "clean":
        parts = F.transform(F.split(F.regexp_replace(c, LIST_SEPARATOR_PATTERN, ","), ","), lambda x: F.trim(x))
        return F.filter(parts, lambda x: x != F.lit(""))
    raise ValueError(f"unknown split mode {mode!r}; expected one of {SPLIT_MODES}")


def split_list_or_empty(c, mode: str = "comma") -> Column:
    """As ``split_list`` but a null list gives an empty array."""
    return F.coalesce(split_list(c, mode), F.array().cast("array<string>"))


def parse_money(c, suffixes: Sequence[str] = ("K", "M", "B"), missing: float | None = 0.0) -> Column:
    """"$76.4M" -> 76400000.0. Accepts an optional "$", a decimal number and
    one of ``suffixes`` (or none). Null or unparsable text gives ``missing``
    (F6, U3).
    ``suffixes=("K", "M")`` reproduces the reference, which loses "B" values.
    """
    c = _col(c)
    pattern = r"^\s*\$?\s*([0-9]+(?:\.[0-9]+)?)\s*([A-Za-z]?)\s*$"
    number = F.regexp_extract(c, pattern, 1).try_cast("double")
    suffix = F.upper(F.regexp_extract(c, pattern, 2))
    scale = F.when(suffix == "", F.lit(1.0))
    for s in suffixes:
        scale = scale.when(suffix == s.upper(), F.lit(MONEY_SUFFIXES[s.upper()]))
    value = number * scale
    return value if missing is None else F.coalesce(value, F.lit(float(missing)))


def five_year_bucket(year_col, first: int = BUCKET_FIRST_YEAR, last: int = BUCKET_LAST_YEAR,
                     width: int = BUCKET_WIDTH) -> Column:
    """Year -> "2020-2024"; outside [first, last] or null -> "Unknown" (F8, U4)."""
    y = _col(year_col)
    start = y - F.pmod(y - F.lit(first), F.lit(width))
    label = F.concat(start.cast("string"), F.lit("-"), (start + F.lit(width - 1)).cast("string"))
    return F.when(y.between(first, last), label).otherwise(F.lit(UNKNOWN_BUCKET))


def imdb_number(c) -> Column:
    """"tt0111161" -> 111161 (characters 3-12 as int; bad text -> null)."""
    return _col(c).substr(3, 10).try_cast("int")


def year_of(c) -> Column:
    """Calendar year of a date, timestamp or date text; bad text -> null."""
    c = _col(c)
    return F.year(F.coalesce(c.try_cast("date"), F.try_to_timestamp(c.cast("string")).cast("date")))


def any_time(c) -> Column:
    """Timestamp from text: epoch seconds (or milliseconds, from 12 digits on)
    or a date-time; bad text -> null (E5)."""
    c = _col(c).cast("string")
    number = c.try_cast("long")
    epoch = F.timestamp_millis(F.when(F.length(F.trim(c)) >= 12, number).otherwise(number * 1000))
    return F.when(number.isNotNull(), epoch).otherwise(F.try_to_timestamp(c))


def stable_index(key, n: int, salt: str = "") -> Column:
    """Deterministic pseudo-random index in [0, n) from a row key.

    First 32 bits of md5(salt || key): the same on every run, partitioning
    and engine (the SQL oracle computes it identically).
    """
    digest = F.md5(F.concat(F.lit(salt), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % F.lit(n)


def stable_choice(key, choices: Sequence, salt: str = "") -> Column:
    """Pick one of ``choices`` per row, deterministically."""
    options = F.array(*[F.lit(v) for v in choices])
    return F.element_at(options, (stable_index(key, len(choices), salt) + 1).cast("int"))


def fix_sentiment(c, key, salt: str = "sentiment:") -> Column:
    """Keep a valid sentiment, impute anything else (including null)."""
    c = _col(c)
    return F.when(c.isin(*SENTIMENTS), c).otherwise(stable_choice(key, SENTIMENTS, salt))


def impute_score(key, salt: str = "score:") -> Column:
    return stable_choice(key, SCORE_CHOICES, salt).cast("float")


def language_class(c) -> Column:
    """"English" stays, anything else (null included) is "Non-English" (F9)."""
    return F.when(_col(c) == ENGLISH, F.lit(ENGLISH)).otherwise(F.lit(NON_ENGLISH))


def pct(part, whole) -> Column:
    """part / whole * 100 as double; null when whole is 0."""
    return F.try_divide(_col(part).cast("double"), _col(whole)) * F.lit(100.0)
