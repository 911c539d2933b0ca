"""Zone tables: read and write by format with declared schemas.

Formats and options are parameters, so the same calls serve CSV raw zones,
Parquet transform zones, JSON curated output and any connector on the
classpath (a search-index sink is ``format=<connector>`` plus its options).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, StringType, StructField, StructType, TimestampType

from cinelake.functions.expressions import any_time

_TEXT_FORMATS = ("csv",)
# Quotes within a quoted field are doubled, as other CSV writers do; times keep
# their microseconds.
_CSV = {"header": "true", "escape": '"', "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | None = None, options: Mapping[str, str] | None = None,
               extra: str = "error", optional: Sequence[str] = (), rejects: str | None = None) -> DataFrame:
    """Scan a zone table (S1 S2 S3; P1 projections follow in the plans).
    Partition directories (``creationDate=2020``) become a column and filters
    on it prune directories.

    CSV columns are taken by the names in the header, in any order, and cast
    to the declared types; there is no inference pass. A declared column
    that the header lacks is an error unless it is ``optional`` (it is then
    left out). ``extra`` says what becomes of undeclared columns: "error",
    "keep" (as text) or "drop". Files of one folder whose headers differ are
    an error. A value that its declared type cannot hold becomes null; ``rejects``
    names a further column that lists such values of the row (see ``split_rejects``)."""
    reader = spark.read.format(fmt)
    given = {**(_CSV if fmt in _TEXT_FORMATS else {}), **(options or {})}
    for k, v in given.items():
        reader = reader.option(k, v)
    if fmt not in _TEXT_FORMATS:
        return (reader if schema is None else reader.schema(schema)).load(path)
    found = reader.load(path).schema
    text = StructType([StructField(f.name, StringType() if f.name in {x.name for x in schema or found} else f.dataType)
                       for f in found])
    table = reader.option("enforceSchema", "false").schema(text).load(path)
    return table if schema is None else _by_name(table, schema, extra, optional, rejects)


def _by_name(table: DataFrame, schema: StructType, extra: str, optional: Sequence[str],
             rejects: str | None) -> DataFrame:
    """Text columns of a CSV table as the declared columns."""
    names = [f.name for f in schema]
    missing = [n for n in names if n not in table.columns and n not in optional]
    unknown = [n for n in table.columns if n not in names]
    if missing or (unknown and extra == "error"):
        raise ValueError(f"CSV header: missing columns {missing}, undeclared columns {unknown}; found {table.columns}")
    declared = [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema if f.name in table.columns]
    lost = [_rejected(table, schema).alias(rejects)] if rejects else []
    return table.select(*declared, *[F.col(f"`{n}`") for n in unknown if extra == "keep"], *lost)


_REJECTS = "array<struct<row:string,column:string,value:string>>"


def _rejected(table: DataFrame, schema: StructType) -> Column:
    """The row's values that do not fit: the whole row as JSON, column, text."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]))
    found = [F.when((F.trim(text) != "") & _typed(text, f.dataType).isNull(),
                    F.struct(row.alias("row"), F.lit(f.name).alias("column"), text.alias("value")))
             for f in schema if f.name in table.columns and not isinstance(f.dataType, StringType)
             for text in [F.col(f"`{f.name}`")]]
    return F.filter(F.array(*found), lambda r: r.isNotNull()) if found else F.lit(None).cast(_REJECTS)


def split_rejects(table: DataFrame, rejects: str) -> tuple[DataFrame, DataFrame, Observation]:
    """A table read with ``rejects``: the clean table, its quarantine rows (row, column,
    value), and an observation whose ``rejected`` counts the latter while the table is written, so that
    the quarantine, a second pass, is written only where there is something to write."""
    seen = Observation()
    clean = table.observe(seen, F.coalesce(F.sum(F.size(rejects)), F.lit(0)).alias("rejected")).drop(rejects)
    return clean, table.select(F.explode(rejects).alias("r")).select("r.*"), seen


def write_quarantine(rejected: DataFrame, seen: Observation, path: str | None) -> int:
    """After the clean table is written: the quarantine at ``path`` (replaced, also by an empty one). Returns the
    number of rejected values."""
    count = int(seen.get["rejected"])
    if path is not None:
        write_table(rejected if count else rejected.limit(0), path)
    return count


def _typed(text: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return text
    if isinstance(kind, TimestampType):
        return any_time(text)
    if isinstance(kind, IntegralType):  # also whole numbers written with a fraction
        return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
    return text.try_cast(kind)


def write_table(df: DataFrame, path: str | None, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None,
                options: Mapping[str, str] | None = None) -> None:
    """Write a zone table (overwrite by default: re-running a job replaces
    its output instead of duplicating it). ``path=None`` for connectors that
    take their target from options."""
    if partition_by:
        # A shuffle that adaptive execution sizes: small partitions of the
        # table become one file, large ones are split over several tasks.
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    for k, v in {**(_CSV if fmt in _TEXT_FORMATS else {}), **(options or {})}.items():
        writer = writer.option(k, v)
    if path is None:
        writer.save()
    else:
        writer.save(path)


def write_many(df: DataFrame, targets: list[dict]) -> None:
    """Several sinks from one result (S10): the frame is persisted once so the
    plan is not recomputed per sink, then released."""
    df = df.persist()
    try:
        for t in targets:
            write_table(df, t.get("path"), t.get("fmt", "parquet"), t.get("mode", "overwrite"),
                        t.get("partition_by"), t.get("options"))
    finally:
        df.unpersist()


def land(tables: Mapping[str, DataFrame], root: str, fmt: str = "csv") -> dict[str, str]:
    """Copy source tables into a zone, one folder per table."""
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path, fmt)
        paths[name] = path
    return paths


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first rows."""
    df.show(n, truncate=False)
