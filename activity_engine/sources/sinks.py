"""Dead-letter sink (S6) and BI feed export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.operators.ingest import dead_letter_json

MARKER = "(run)"
CORRUPT_REASON = "Document could not be parsed"
FEED_TABLES = ("dim_agent", "dim_lead", "dim_campaign", "dim_date", "fact_outreach_activity",
               "fact_daily_agent_metric", "dq_audit_log", "pipeline_runs")


def corrupt_letters(corrupt: DataFrame, now) -> DataFrame:
    """Documents that could not be parsed, as dead-letter rows."""
    return corrupt.select("record", F.lit(CORRUPT_REASON).alias("failure_reason"), now.alias("timestamp"))


def write_dead_letters(dead: DataFrame, path: str, run_id: str, more: DataFrame | None = None) -> None:
    """Write dead-letter rows as JSON lines under ``run_id=<id>``.

    The record is kept as JSON text with nulls written out, next to the
    reason and the time. Only this run's partition is replaced (dynamic
    overwrite), so a retried run or a replayed micro-batch rewrites its own
    dead letters instead of adding a second copy; other runs are untouched.
    A marker row, which reading leaves out, replaces an earlier attempt's rows even
    where this one has none. ``more`` are rows that are dead-letter text already.
    """
    rows = dead_letter_json(dead)
    if more is not None:
        rows = rows.unionByName(more)
    marker = rows.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("record"), F.lit(MARKER).alias("failure_reason"),
        F.lit(None).cast("timestamp").alias("timestamp"))
    (rows.unionByName(marker).withColumn("run_id", F.lit(run_id))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").json(path))


def read_dead_letters(spark, path: str) -> DataFrame:
    return spark.read.schema(
        "record string, failure_reason string, timestamp timestamp, run_id string").json(path) \
        .where(F.col("failure_reason") != MARKER)


def export_feed(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Full-refresh export of one table: CSV with a header, or Parquet."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown feed format {fmt!r}")


def export_warehouse(wh, out_dir: str, fmt: str = "csv", tables=FEED_TABLES) -> list[str]:
    """E5: every warehouse table to ``out_dir/<table>``, one without rows as its header."""
    written = []
    for t in tables:
        df = wh.read(t)
        if df is not None:
            export_feed(df, f"{out_dir.rstrip('/')}/{t}", fmt)
            written.append(t)
    return written
