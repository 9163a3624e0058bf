"""Fact-load operators: quarantine split, typing, dedupe, idempotent insert.

J1 (key resolution) lives in ``keys.py``; these take its output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.config import QUARANTINE_REASON
from activity_engine.functions.dates import to_event_ts

FACT_COLUMNS = ("event_id", "agent_sk", "lead_sk", "campaign_sk", "date_key",
                "event_timestamp", "event_ts", "event_type", "message_length",
                "response_latency_hours", "is_converted")


def quarantine_flag(df: DataFrame) -> Column:
    """unresolved key, or a missing mandatory field, or an empty type."""
    return (F.col("agent_sk").isNull() | F.col("lead_sk").isNull()
            | F.col("campaign_sk").isNull() | F.col("event_timestamp").isNull()
            | F.col("event_type").isNull() | (F.col("event_type") == F.lit(""))
            | F.col("event_id").isNull() | F.col("date_key").isNull())


def split_quarantine(resolved: DataFrame, record_cols: list[str],
                     now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """one resolved batch -> (valid rows, dead-letter rows).

    The flag is computed once; the caller persists ``resolved`` if both
    outputs are consumed. Dead-letter rows keep the original record as a
    struct, the reason and the time (P15).
    """
    now = now if now is not None else F.current_timestamp()
    flagged = resolved.withColumn("_bad", quarantine_flag(resolved))
    valid = flagged.where(~F.col("_bad")).drop("_bad")
    dead = flagged.where(F.col("_bad")).select(
        F.struct(*[F.col(c) for c in record_cols]).alias("record"),
        F.lit(QUARANTINE_REASON).alias("failure_reason"),
        now.alias("timestamp"))
    return valid, dead


def dead_letter_json(dead: DataFrame) -> DataFrame:
    """Dead-letter rows with the record as JSON text, nulls kept."""
    return dead.select(
        F.to_json("record", {"ignoreNullFields": "false"}).alias("record"),
        "failure_reason", "timestamp")


def to_fact_rows(valid: DataFrame) -> DataFrame:
    """Typed fact rows with defaults."""
    ts_type = valid.schema["event_timestamp"].dataType
    return valid.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("agent_sk").cast("long").alias("agent_sk"),
        F.col("lead_sk").cast("long").alias("lead_sk"),
        F.col("campaign_sk").cast("long").alias("campaign_sk"),
        F.col("date_key").cast("int").alias("date_key"),
        F.col("event_timestamp").cast("string").alias("event_timestamp"),
        to_event_ts("event_timestamp", ts_type).alias("event_ts"),
        F.col("event_type").cast("string").alias("event_type"),
        F.coalesce(F.col("message_length").try_cast("int"), F.lit(0)).alias("message_length"),
        F.col("response_latency_hours").try_cast("double").alias("response_latency_hours"),
        F.coalesce(F.col("is_converted").try_cast("int"), F.lit(0)).alias("is_converted"),
        *([F.col("ingest_order")] if "ingest_order" in valid.columns else []),
    )


def dedupe_first_wins(df: DataFrame, key: str = "event_id",
                      order_col: str = "ingest_order") -> DataFrame:
    """Keep the first arrival per key.

    Expressed as ``min_by`` in a group-by rather than a ``row_number``
    window: the aggregate is combined map-side, so a key that holds a third
    of the rows is reduced before the shuffle instead of landing whole in
    one task. Ties on the arrival order break on a hash of the whole row.
    """
    cols = [c for c in df.columns if c != key]
    rank = F.struct(F.col(order_col), F.xxhash64(*[F.col(c) for c in df.columns]))
    return (df.groupBy(key)
            .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), rank).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols]))


def key_hash(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def repeated_hashes(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Hashes ``_hash`` of the keys, as text, that may have several rows: no other key has."""
    return (df.groupBy(key_hash(key).alias("_hash")).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1).select("_hash"))


def dedupe_repeated(df: DataFrame, repeated: DataFrame, key: str = "event_id",
                    order_col: str = "ingest_order") -> DataFrame:
    """W9 where ``repeated_hashes`` of the rows, or of more, are known: only their rows are sorted.

    The result is that of ``dedupe_first_wins``. A hash that several keys share only
    brings their rows into that aggregate too. With ``repeated`` cached, its size decides
    whether it is broadcast.
    """
    hashed = df.withColumn("_hash", key_hash(key))
    once = hashed.join(repeated, "_hash", "left_anti").select(*df.columns)
    more = hashed.join(repeated, "_hash", "left_semi").select(*df.columns)
    return once.unionByName(dedupe_first_wins(more, key, order_col))


def insert_new(batch: DataFrame, existing: DataFrame | None, key: str = "event_id") -> DataFrame:
    """Rows of the (deduped) batch whose key is nowhere in the table yet.

    The key is unique over the whole table, whatever day its row fell on, so
    the anti join is on the key alone; of the table it reads that one column.
    """
    if existing is None:
        return batch
    return batch.join(existing.select(key), key, "left_anti")


def high_watermark(batch: DataFrame, ts_col: str = "event_timestamp",
                   previous: Column | None = None, parsed: bool = False) -> DataFrame:
    """Max event time of the raw batch, quarantined rows included.

    The studied pipeline takes a string max and overwrites the old value;
    ``parsed=True`` compares parsed times and ``previous`` makes the mark
    monotonic (``greatest(previous, new)``).
    """
    c = F.col(ts_col)
    if parsed:
        c = to_event_ts(c, batch.schema[ts_col].dataType)
    m = batch.agg(F.max(c).alias("watermark"))
    if previous is not None:
        m = m.select(F.greatest(F.col("watermark"), previous).alias("watermark"))
    return m


def incremental_filter(batch: DataFrame, watermark: Column, ts_col: str = "event_ts") -> DataFrame:
    """Only events strictly after the watermark."""
    return batch.where(F.col(ts_col) > watermark)
