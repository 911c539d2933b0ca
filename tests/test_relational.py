"""Relational operators: ties, nulls, duplicates, null-safe semi joins."""

import pytest
from pyspark.sql import functions as F

from cinelake.operators import relational as R


def test_top_k_per_group_ties(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "x", 2)],
                               "g string, k string, n int")
    kept = R.top_k_per_group(df, ["g"], [F.desc("n")], 1, ties=True)
    assert sorted((r.g, r.k) for r in kept.collect()) == [("a", "x"), ("a", "y"), ("b", "x")]
    one = R.top_k_per_group(df, ["g"], [F.desc("n"), F.asc("k")], 1)
    assert sorted((r.g, r.k) for r in one.collect()) == [("a", "x"), ("b", "x")]


def test_global_rank_keeps_ties(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([5, 5, 4, 3, 3, 3, 1, None])], "i int, n int")
    assert [R.top_ranked(df, "n", k).count() for k in (1, 2, 3, 4, 6, 7, 9)] == [2, 2, 3, 6, 6, 7, 7]
    assert R.top_ranked(df.where("false"), "n", 3).count() == 0
    with pytest.raises(ValueError):
        R.top_k_per_group(df, [], [F.desc("n")], 3, ties=True)


def test_thousands_of_tied_films(spark):
    df = spark.range(20_000).selectExpr("id", "CAST(least(id, 14999) AS DOUBLE) AS share")
    best = R.top_ranked(df, "share", 5)
    assert best.count() == 5001
    plan = best._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    one = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert all("TakeOrderedAndProject" in "".join(lines[i:i + 2]) for i in one)


def test_explode_list_drops_null(spark):
    df = spark.createDataFrame([(1, "a, b"), (2, None), (3, "")], "id int, l string")
    rows = sorted(tuple(r) for r in R.explode_list(df, "l").collect())
    assert rows == [(1, "a"), (1, "b"), (3, "")]


def test_certified(spark):
    rows = [(1, True, "POSITIVE")] * 5 + [(1, None, "NEGATIVE")] * 3 + [(2, True, "POSITIVE")] * 4
    df = spark.createDataFrame(rows, "movie_id int, isTopCritic boolean, scoreSentiment string")
    got = R.certified(df, 0.75, 5, 5).collect()
    assert [(r.movie_id, r.positive_reviews, r.total_reviews) for r in got] == [(1, 5, 5)]


def test_pivot_sum_missing_cell_is_null(spark):
    df = spark.createDataFrame([("w1", "POSITIVE", 2), ("w1", "NEGATIVE", 1), ("w2", "NEGATIVE", 4)],
                               "writer string, s string, n long")
    out = {r.writer: (r.POSITIVE, r.NEGATIVE)
           for r in R.pivot_sum(df, ["writer"], "s", ["POSITIVE", "NEGATIVE"], "n").collect()}
    assert out == {"w1": (2, 1), "w2": (None, 4)}
    native = df.groupBy("writer").pivot("s", ["POSITIVE", "NEGATIVE"]).agg(F.sum("n"))
    assert sorted(map(tuple, native.collect())) == sorted((k, *v) for k, v in out.items())


def test_semi_join_null_safe(spark):
    left = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r.k or 0 for r in R.semi_join(left, right, "k", null_safe=True).collect()) == [0, 1]
    assert [r.k for r in R.semi_join(left, right, "k").collect()] == [1]


def test_null_safe_semi_join_spreads_nulls_and_keys_repeat(spark):
    left = spark.range(4000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN id END AS k")
    right = spark.range(3000).selectExpr("CASE WHEN id % 2 = 0 THEN id % 100 END AS k")
    kept = R.semi_join(left, right, "k", null_safe=True)
    assert kept.count() == 3000 + 25 and kept.columns == left.columns
    assert R.semi_join(left, right.where("k is not null"), "k", null_safe=True).count() == 25
    assert R.semi_join(left, right, "k").count() == 25


def test_latest_by_key(spark):
    df = spark.createDataFrame([("d", 1, 0, 5), ("d", 2, 0, 6), ("d", 2, 1, 7), ("e", 1, 3, 1)],
                               "doc_id string, window_end int, batch_id int, v int")
    out = {r.doc_id: r.v for r in R.latest_by_key(df, "doc_id", ["window_end", "batch_id"]).collect()}
    assert out == {"d": 7, "e": 1}


def test_dedupe_by_keeps_max(spark):
    df = spark.createDataFrame([("t", 3), ("t", 9), ("u", 1)], "title string, total_reviews int")
    assert sorted(map(tuple, R.dedupe_by(df, "title", "total_reviews").collect())) == [("t", 9), ("u", 1)]


@pytest.mark.parametrize("rows_a_task", [10, 1000, 10 ** 9])
def test_left_join_with_a_key_listed_very_often(spark, rows_a_task):
    """One title listed 100,000 times (the same row each time), others a few times or
    never; null keys on both sides; equal to the plain left join."""
    films = spark.createDataFrame([(1, "hot"), (2, "hot"), (3, "twice"), (4, "none"), (5, None), (5, None)], "id int, title string")
    listed = spark.range(100_000, numPartitions=4).selectExpr("'hot' as name", "cast(7 as long) as ref").unionByName(
        spark.createDataFrame([("twice", 8), ("twice", 9), ("else", 1), (None, 2)], "name string, ref long"))
    got = R.left_join_frequent(films, listed, "title", "name", rows_a_task)
    want = films.join(listed, films["title"] == listed["name"], "left").drop("name")
    assert got.columns == want.columns == ["id", "title", "ref"]
    count = lambda df: sorted(map(tuple, df.groupBy("id", "title", "ref").count().collect()), key=repr)
    assert count(got) == count(want) and got.count() == 200_005


def test_a_frequent_key_is_dealt_over_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        films = spark.createDataFrame([(1, "hot")], "id int, title string")
        listed = spark.range(20_000, numPartitions=4).selectExpr("'hot' as name", "id as ref")
        joined = R.left_join_frequent(films, listed, "title", "name", 1000)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 20_000 and max(r["count"] for r in sizes) < 12_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
