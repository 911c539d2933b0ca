"""Review messages: encode rows as keyed JSON, decode them back (F15-F17, ST1).

The wire format follows the producer: value is a JSON object of the row with
the event time as "yyyy-MM-dd HH:mm:ss"; key is "userId_movieId_timestamp".
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cinelake.sources.schemas import REVIEW_EVENT

# Fixed value: event-time text format on the wire.
WIRE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEY_FIELDS = ("userId", "movieId", "timestamp")
PAYLOAD_FIELDS = ("userId", "movieId", "rating", "title", "genres", "tmdbId", "imdbId", "timestamp")


def encode(df: DataFrame, time_col: str = "timestamp", fields: Sequence[str] = PAYLOAD_FIELDS,
           key_fields: Sequence[str] = KEY_FIELDS, stamp_send_time: bool = False,
           partitions: int | None = None) -> DataFrame:
    """Rows -> (key, value) binary pairs, ready for a broker or a file topic.

    ``stamp_send_time`` replaces the event time by the send time, as the
    reference's producer does (F18); replays for tests keep the event time.
    ``partitions`` spreads the rows over that many tasks first (round robin, so
    no key can make one topic file large); by default they are encoded where
    they lie. Encoding runs no job. Without a ``time_col`` in the rows the
    send time must be stamped."""
    when = F.current_timestamp() if stamp_send_time else F.col(time_col)
    present = [f for f in fields if f in df.columns or (f == time_col and stamp_send_time)]
    staged = df.select(F.date_format(when, WIRE_TIME_FORMAT).alias("__wire_time"),
                       *[F.col(f) for f in present if f != time_col])
    wire = {f: (F.col("__wire_time") if f == time_col else F.col(f)) for f in set(present) | set(key_fields)}
    key = F.concat_ws("_", *[wire[f].cast("string") for f in key_fields])
    staged = staged.withColumn("__key", key)
    if partitions:
        staged = staged.repartition(partitions)
    payload = F.struct(*[wire[f].alias(f) for f in present])
    return staged.select(F.encode(F.col("__key"), "UTF-8").alias("key"),
                         F.encode(F.to_json(payload), "UTF-8").alias("value"))


def decode(messages: DataFrame, schema: StructType = REVIEW_EVENT, keep_key: bool = False) -> DataFrame:
    """(key, value) -> one column per schema field (ST1 F14 F15 P15). Malformed JSON gives an
    all-null row, a bad field a null field (from_json PERMISSIVE)."""
    parsed = F.from_json(F.col("value").cast("string"), schema, {"timestampFormat": WIRE_TIME_FORMAT})
    cols = [F.col("key").cast("string").alias("key")] if keep_key else []
    return messages.select(*cols, parsed.alias("m")).select(*([("key")] if keep_key else []), "m.*")


# Why a message is a dead letter.
UNDECODABLE, NO_TIME = "undecodable", "no event time"


def triage(messages: DataFrame, schema: StructType = REVIEW_EVENT, time_col: str = "timestamp") -> DataFrame:
    """Every message with a ``reason``: null for an event that a question can use, else why
    not: its value is no JSON object, or it has no event time that can be read."""
    text = F.col("value").cast("string")
    parsed = F.from_json(text, schema, {"timestampFormat": WIRE_TIME_FORMAT})
    untimed = F.coalesce(parsed.getField(time_col).isNull(), F.lit(True))
    object_ = F.from_json(text, "map<string,string>").isNotNull()
    return messages.select("key", "value", F.when(untimed & object_, F.lit(NO_TIME))
                           .when(untimed, F.lit(UNDECODABLE)).alias("reason"))
