"""Exact duplicates by a content sort, in DataFrame functions only.

Texts are normalised (each run of white space becomes one space) and sorted by
their bytes: rows are dealt out by sampled splitters over the order (first
``HEAD`` characters, a hash of all bytes), so that splitters stay short and a
passage that many texts begin with does not fill one range; each range is sorted
externally by that order and then by the whole bytes, and neighbours whose whole
bytes are equal form a run. A run's rows lie in order of their identifier, so its
first row stays.

A text with many copies would fill one range. Such texts are known beforehand
from counts of hashes (pre-aggregated, 16 bytes a row): more copies than a quarter
of a range's fair share, which at most four texts a range can have, whatever the
table's size. Their rows are sliced by identifier and each slice is a run of its
own; the slices' first rows, whole texts included, are compared again and give the
whole group's numbers.

Defined results: a null text is empty; null identifiers come last, so they stay
only where a group has no other; rows that repeat an identifier and a text are
copies of each other and one of them stays; an empty table gives no rows. Only
the two named columns are read, whatever else the table has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.tables import prepare, staged

#: Characters of a text that the splitters hold.
HEAD = 24
#: Copies that one run may always have.
RUN = 64


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _crowded(rows: DataFrame, total: int) -> DataFrame:
    """(hash, slices) of the texts of ``total`` rows that have more copies than one run shall hold:
    a quarter of a range's fair share, hence at most 4 rows a range."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(RUN, total / (4 * ranges))
    counts = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
    return counts.select("hash", F.ceil(F.col("n") / share).cast("int").alias("slices"))


def _runs(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Rows with their place in their run, its first identifier and its length; the
    texts of crowded runs' first rows."""
    rows = docs.select(docs[key].cast("long").alias("doc_id"), normalised(text).alias("bytes")).select(
        "doc_id", "bytes", F.substring("bytes", 1, HEAD).alias("head"), F.xxhash64("bytes").alias("hash"))
    crowded = F.broadcast(staged(_crowded(rows.select("hash"), docs.count()), "crowded-texts"))  # 4 rows a range at most
    sliced = rows.join(crowded, "hash", "left").withColumn(
        "slice", F.when(F.col("slices").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("slices"))).cast("int"))
    dealt = sliced.repartitionByRange("head", "hash", "slice")
    run = Window.partitionBy("head", "hash", "slice", "bytes")
    ordered = run.orderBy(F.asc_nulls_last("doc_id"))
    crowd = F.col("slices").isNotNull()
    first = F.row_number().over(ordered)
    return dealt.select(
        "doc_id", "slice", crowd.alias("crowded"), "bytes", first.alias("place"),
        F.first("doc_id").over(ordered).alias("keep_id"), F.count(F.lit(1)).over(run).alias("group_size"),
    ).select("doc_id", "slice", "crowded", "place", "keep_id", "group_size", F.sha2("bytes", 256).alias("text_sha256"),
             F.when(F.col("crowded") & (F.col("place") == 1), F.col("bytes")).alias("bytes"))


def exact_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    prepare(docs.sparkSession)
    runs = staged(_runs(docs, text, key), "content-runs")
    groups = runs.where("crowded and place = 1").groupBy("bytes").agg(
        F.min(F.struct(F.col("keep_id").isNull(), "keep_id", "slice")).alias("least"),
        F.sum("group_size").alias("n"), F.first("text_sha256").alias("text_sha256"))
    groups = F.broadcast(groups.select("text_sha256", F.col("least.keep_id").alias("least_id"),
                                       F.col("least.slice").alias("least_slice"), "n"))  # one a crowded text
    done = runs.drop("bytes").join(groups, "text_sha256", "left")
    return done.select(
        "doc_id", F.when(F.col("crowded"), F.col("least_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", "group_size").alias("group_size"),
        ((F.col("place") == 1) & (~F.col("crowded") | (F.col("slice") == F.col("least_slice")))).alias("kept"),
        "text_sha256")
