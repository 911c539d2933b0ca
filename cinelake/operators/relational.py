"""Relational building blocks shared by the batch and stream plans.

Every function is DataFrame -> DataFrame and declarative, so Catalyst keeps
pruning, pushdown and partial (map-side) aggregation. Nothing here collects to
the driver; top-k results that feed a later join are joined as frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.functions.expressions import split_list


def _cols(cs) -> list:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def explode_list(df: DataFrame, column: str, mode: str = "regex", alias: str | None = None) -> DataFrame:
    """One row per element of a packed list column (null list -> no row)."""
    out = alias or column
    others = [c for c in df.columns if c != column and c != out]
    return df.select(*others, F.explode(split_list(column, mode)).alias(out))


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """Global top k by ``order`` (TakeOrderedAndProject: each task keeps its
    own k best, only k rows per task reach the final merge) (L1, L2)."""
    return df.orderBy(*_cols(order)).limit(k)


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence, k: int,
                    ties: bool = False, rank_col: str | None = None) -> DataFrame:
    """Best ``k`` rows per group.

    ``ties=True`` keeps every row whose rank() <= k (the reference's rank
    filter); otherwise row_number() with ``order`` as the full tie-break.
    The filter sits right after the window so Spark plans a WindowGroupLimit
    and drops losers before the window's sort. Ranks over all rows go through
    ``top_ranked``, which needs no window over them.
    """
    if not keys:
        raise ValueError("no keys: use top_ranked, or top_k for a fixed number of rows")
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    fn = F.rank() if ties else F.row_number()
    name = rank_col or "__rank"
    ranked = df.withColumn(name, fn.over(w)).filter(F.col(name) <= k)
    return ranked if rank_col else ranked.drop(name)


def top_ranked(df: DataFrame, by: str, k: int) -> DataFrame:
    """Rows whose rank() by descending ``by`` is at most ``k``, ties kept
    (W3). Null values do not rank.

    A group-by on the value (partial aggregate) and a top-k leave the k best
    values with their row counts; a value qualifies if fewer than k rows have
    a better one. The rows are then filtered by a join with those values (at
    most k, hence the broadcast), so tied rows never meet in one task."""
    values = df.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    best = top_k(values, [F.desc("__value")], k)
    before = F.sum("__n").over(Window.orderBy(F.desc("__value")).rowsBetween(Window.unboundedPreceding, -1))
    chosen = best.withColumn("__before", before).where(F.coalesce("__before", F.lit(0)) < k)
    return df.join(F.broadcast(chosen.select("__value")), df[by] == F.col("__value"), "left_semi")


def facts_by_dimension(facts: DataFrame, dim: DataFrame, key: str, fact_keys: Sequence[str],
                       measures: dict[str, Column | None]) -> DataFrame:
    """Fact measures per ``key`` (+ ``fact_keys``) attached to the dimension
    rows, ready to be re-aggregated with ``sum`` at any dimension grain.

    ``measures`` maps an output name to a condition (count rows where it is
    true) or None (count all rows). Facts are aggregated per key first, with
    a partial aggregate before the shuffle, so a key holding a third of all
    rows costs one row per map task and the join sees one row per key. Join
    strategy is left to Spark (no hint)."""
    per_key = facts.groupBy(key, *fact_keys).agg(
        *[(F.count(F.lit(1)) if c is None else F.count_if(c)).alias(n) for n, c in measures.items()])
    return per_key.join(dim, key)


def review_counts(reviews: DataFrame, keys: Sequence[str] = ("movie_id",)) -> DataFrame:
    """Per-film review statistics in one aggregate (A2, A3).

    This is the pre-aggregation every batch plan starts from: the review fact
    table collapses to one row per key before any join, and the partial
    aggregate runs before the shuffle, so a film holding a large share of all
    reviews costs one row per map task.
    """
    return reviews.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.count_if(F.col("scoreSentiment") == "POSITIVE").alias("positive_reviews"),
        F.count_if(F.col("scoreSentiment") == "NEGATIVE").alias("negative_reviews"),
        F.count_if(F.col("isTopCritic")).alias("top_critic_reviews"),
    )


def certified(reviews: DataFrame, min_ratio: float = 0.75, min_top_critics: int = 5,
              min_positive: int = 80) -> DataFrame:
    """"Certified fresh" films (P9, P13, A3): reviews with a known top-critic
    flag, positive share >= ratio, enough top critics and positives.
    Columns: movie_id, positive_reviews, top_critic_reviews, total_reviews."""
    counts = reviews.filter(F.col("isTopCritic").isNotNull()).groupBy("movie_id").agg(
        F.count_if(F.col("scoreSentiment") == "POSITIVE").alias("positive_reviews"),
        F.count_if(F.col("isTopCritic")).alias("top_critic_reviews"),
        F.count(F.lit(1)).alias("total_reviews"),
    )
    return counts.filter(
        (F.col("positive_reviews") / F.col("total_reviews") >= min_ratio)
        & (F.col("top_critic_reviews") >= min_top_critics)
        & (F.col("positive_reviews") >= min_positive)
    )


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence[str],
              measure: str) -> DataFrame:
    """sum(measure) per key with one column per declared pivot value (A8);
    a missing cell is null, as with ``pivot``. Written as conditional sums:
    one aggregate (one shuffle) where ``groupBy().pivot()`` plans two."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(measure))).alias(str(v)) for v in values])


# Shares of the null keys of a null-safe semi join.
NULL_SALTS = 32


def semi_join(df: DataFrame, keys_df: DataFrame, left_on: str, right_on: str | None = None,
              null_safe: bool = False) -> DataFrame:
    """Keep rows of ``df`` whose key occurs in ``keys_df``.

    Replaces driver-side collect + isin. Keys are made distinct first (partial
    aggregate). ``null_safe`` makes a null key match a null key, as a Python
    ``None in dict`` test does: null rows are dealt over ``NULL_SALTS`` salts,
    each of which the null key (one row, if there is one) carries.
    """
    right_on = right_on or left_on
    keys = keys_df.select(F.col(right_on).alias("__k"))
    if not null_safe:
        keys = keys.where(F.col("__k").isNotNull()).distinct()
        return df.join(keys, df[left_on] == keys["__k"], "left_semi")
    none = F.when(F.col("__k").isNull(), F.sequence(F.lit(0), F.lit(NULL_SALTS - 1))).otherwise(F.array(F.lit(-1)))
    keys = keys.distinct().select("__k", F.explode(none).alias("__s")).select(
        F.struct("__k", "__s").alias("__k2"))
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SALTS)).cast("int")
    own = F.struct(F.col(left_on).alias("__k"), F.when(F.col(left_on).isNull(), salt).otherwise(F.lit(-1)).alias("__s"))
    return df.withColumn("__key", own).join(keys, F.col("__key") == F.col("__k2"), "left_semi").drop("__key")


#: Rows of one key that a task of ``left_join_frequent`` may always take, and the
#: most keys it salts: a key beyond them has under a 1024th of the rows.
FREQUENT_ROWS, FREQUENT_KEYS = 10_000, 1024


def left_join_frequent(df: DataFrame, listed: DataFrame, left_on: str, right_on: str,
                       rows_a_task: int = FREQUENT_ROWS) -> DataFrame:
    """Left join to a list that may hold a key very often (J6); ``right_on`` is
    dropped. Adaptive execution splits the left side of a left join only.

    One aggregate of the list finds its frequent keys. Their list rows are dealt
    over salts of about ``rows_a_task`` rows, and a row of ``df`` with such a key
    is copied to all salts of its key (the list has the key, so a copy that meets no
    row is dropped, not null-extended). All other rows meet in salt 0 of the same join,
    which reads ``df`` once."""
    known = listed.where(F.col(right_on).isNotNull())
    counts = known.groupBy(F.col(right_on).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    frequent = top_k(counts.where(F.col("__rows") > rows_a_task), [F.desc("__rows"), "__key"], FREQUENT_KEYS).select(
        "__key", F.ceil(F.col("__rows") / rows_a_task).cast("int").alias("__salts"))
    frequent = F.broadcast(frequent)  # FREQUENT_KEYS rows at most
    own = F.pmod(F.monotonically_increasing_id(), F.coalesce("__salts", F.lit(1))).cast("int")
    right = known.withColumn("__on", F.col(right_on)).join(frequent, F.col("__on") == F.col("__key"), "left").select(
        *[c for c in listed.columns if c != right_on], "__on", own.alias("__salt"), F.lit(True).alias("__met"))
    copies = F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)
    left = df.join(frequent, df[left_on] == F.col("__key"), "left").select(
        *df.columns, F.col("__salts").isNotNull().alias("__copied"), F.explode(copies).alias("__copy"))
    joined = left.join(right, (left[left_on] == right["__on"]) & (left["__copy"] == right["__salt"]), "left")
    return joined.where(F.col("__met") | ~F.col("__copied")).drop("__copied", "__copy", "__on", "__salt", "__met")


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per ``key``: the one with the greatest ``order`` tuple (ST12).

    The row-number filter plans a WindowGroupLimit, so each task passes on one
    row per key: a key with a huge history costs one row per map task.
    """
    return top_k_per_group(df, [key], [F.desc(c) for c in order], 1)


def dedupe_by(df: DataFrame, key: str, keep_max: str) -> DataFrame:
    """One row per ``key`` keeping the largest ``keep_max`` (A10, deterministic)."""
    return df.groupBy(key).agg(F.max(keep_max).alias(keep_max))
