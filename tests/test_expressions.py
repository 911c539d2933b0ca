"""Column expressions on hand-made edge rows."""

from pyspark.sql import functions as F

from cinelake.functions import expressions as X


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first().r


def test_split_modes(spark):
    text = " a , b,c ,, d"
    assert _one(spark, lambda c: X.split_list(c, "regex"), text) == [" a", "b", "c", "", "d"]
    assert _one(spark, lambda c: X.split_list(c, "comma"), text) == [" a ", " b", "c ", "", " d"]
    assert _one(spark, lambda c: X.split_list(c, "comma_space"), "a, b,c") == ["a", "b,c"]
    assert _one(spark, lambda c: X.split_list(c, "comma_trim"), text) == ["a", "b", "c", "", "d"]
    assert _one(spark, lambda c: X.split_list(c, "clean"), text) == ["a", "b", "c", "d"]


def test_split_null_and_empty(spark):
    assert _one(spark, lambda c: X.split_list(c), None) is None
    assert _one(spark, lambda c: X.split_list(c), "") == [""]
    assert _one(spark, lambda c: X.split_list_or_empty(c), None) == []


def test_parse_money(spark):
    cases = {"$76.4M": 76.4e6, "$858.4K": 858400.0, "$1.2B": 1.2e9, "$500": 500.0,
             None: 0.0, "n/a": 0.0, " $ 3 k ": 3000.0}
    for text, want in cases.items():
        got = _one(spark, X.parse_money, text)
        assert abs(got - want) < 1e-6 * max(1.0, want), (text, got)


def test_parse_money_reference_parity(spark):
    parity = lambda c: X.parse_money(c, suffixes=("K", "M"), missing=None)
    assert _one(spark, parity, "$1.2B") is None
    assert _one(spark, parity, None) is None
    assert _one(spark, parity, "$2.5M") == 2.5e6


def test_five_year_bucket(spark):
    want = {1969: "Unknown", 1970: "1970-1974", 1974: "1970-1974", 2003: "2000-2004",
            2024: "2020-2024", 2025: "Unknown", None: "Unknown"}
    for year, label in want.items():
        assert _one(spark, X.five_year_bucket, year, "int") == label


def test_imdb_number(spark):
    assert _one(spark, X.imdb_number, "tt0111161") == 111161
    assert _one(spark, X.imdb_number, "ttabc") is None
    assert _one(spark, X.imdb_number, None) is None


def test_year_of(spark):
    assert _one(spark, X.year_of, "2021-06-30") == 2021
    assert _one(spark, X.year_of, "junk") is None


def test_stable_choice_is_deterministic(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = df.select(X.stable_choice("k", ["x", "y", "z"]).alias("c"))
    b = df.repartition(7).select(X.stable_choice("k", ["x", "y", "z"]).alias("c"))
    counts = {r.c: r["count"] for r in a.groupBy("c").count().collect()}
    assert sorted(a.collect()) == sorted(b.collect())
    assert set(counts) == {"x", "y", "z"} and min(counts.values()) > 500


def test_fix_sentiment_and_language(spark):
    df = spark.createDataFrame([("POSITIVE", "1"), ("bogus", "2"), (None, "3")], "s string, k string")
    out = [r.r for r in df.select(X.fix_sentiment("s", F.col("k")).alias("r")).collect()]
    assert out[0] == "POSITIVE" and set(out[1:]) <= {"POSITIVE", "NEGATIVE"}
    assert _one(spark, X.language_class, None) == "Non-English"
    assert _one(spark, X.language_class, "English") == "English"


def test_pct_guards_zero(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a long, b long")
    assert [r.p for r in df.select(X.pct("a", "b").alias("p")).collect()] == [25.0, None]
