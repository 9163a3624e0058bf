"""Structured Streaming realisations of the ingest.

The studied pipeline is batch with a high-watermark file. As a stream:
the file source's checkpoint replaces the watermark file (T1); every
micro-batch runs the batch ingest through ``foreachBatch`` (T4), whose
first-arrival dedupe and anti join against the event-id index make replays
idempotent (T2); daily counts are a stateful aggregation over the fact's own
files (T3); and the risk model is refreshed from the agent-days a batch touched (T5).

No event-time watermark is used on purpose: Spark's watermarked dedupe and
windowed aggregations drop rows that arrive later than the watermark, and a
late event must still be counted.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from activity_engine.operators.daily import daily_counts
from activity_engine.plans import pipeline as pl
from activity_engine.sources.fixtures import events_view
from activity_engine.sources.tables import Warehouse


def read_event_stream(spark: SparkSession, src_dir: str, file_glob: str = "events*.parquet",
                      max_files: int | None = None, schema=None, fmt: str = "parquet") -> DataFrame:
    """New event files under ``src_dir`` as an unbounded DataFrame.

    With a ``schema`` the folder may still be empty; without one it is that of
    the files already there. ``fmt`` is parquet or json.
    """
    if schema is None:
        schema = spark.read.format(fmt).option("pathGlobFilter", file_glob).load(src_dir).schema
    r = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(src_dir)


def start_ingest(stream: DataFrame, wh: Warehouse, dlq_path: str, checkpoint: str,
                 now=None, refresh_risk: bool = False, available_now: bool = True
                 ) -> StreamingQuery:
    """T4/T5: each micro-batch runs DQ audit, dead letters, fact load and
    the run ledger, like a batch run.

    The run key is (query, batch id); the query's identity is its checkpoint
    location, which survives restarts. A retried micro-batch replays the same
    files: its ledger rows and dead letters are replaced, and the fact anti
    join makes the load a no-op.
    """
    qid = hashlib.sha1(checkpoint.encode()).hexdigest()[:10]

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{qid}-{batch_id}"
        pl.ingest_activities(wh, batch, run_id, dlq_path, now)
        if refresh_risk:
            touched = batch.select("agent_id", "date_key").distinct().join(
                wh.read("dim_agent").where(F.col("is_current") == 1)
                .select("agent_id", "agent_sk"), "agent_id")
            pl.run_risk_model(wh, now=now, affected=touched)

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


COUNTS = "stream_daily_counts"
#: Part of the counts table that holds what earlier micro-batches left.
FOLDED = -1


def start_daily_counts(wh: Warehouse, checkpoint: str, table: str = COUNTS, max_files: int | None = None,
                       available_now: bool = True, fold_every: int = 100) -> StreamingQuery:
    """Agent x day counts (A1) kept by a stateful aggregation over the fact's own files.

    The source is the fact that ``start_ingest`` (or a batch load) appends to, so what is
    counted is what was really inserted: quarantined events, replays and later copies of
    an id never reach it, and a first arrival is one by the load's order. The state store
    holds one row an agent and day, whatever the number of events. There is no watermark:
    a row of any age finds its state, so late rows need no other path and none is dropped.

    Each micro-batch writes the new totals of the agent-days it changed under its own
    ``batch_id`` (a retried one replaces them); totals are absolute, so reading takes the
    last of each agent-day, and every ``fold_every`` micro-batches they are folded into
    one part. Start it once the fact exists; it follows the fact's current version.
    """
    fact = wh.read("fact_outreach_activity")
    if fact is None:
        raise RuntimeError("the fact has no rows yet: start the ingest first")
    reader = wh.spark.readStream.schema(fact.schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    counts = daily_counts(reader.parquet(wh.current_path("fact_outreach_activity")))

    def write_changed(batch: DataFrame, batch_id: int) -> None:
        totals = batch.withColumns({"as_of": F.lit(batch_id), "batch_id": F.lit(batch_id)})
        wh.overwrite_partitions(table, totals, "batch_id")
        if fold_every and batch_id and batch_id % fold_every == 0:
            fold_daily_counts(wh, table)

    w = (counts.writeStream.outputMode("update").foreachBatch(write_changed)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _last_totals(rows: DataFrame) -> DataFrame:
    values = [c for c in rows.columns if c not in ("agent_sk", "date_key", "batch_id")]
    return (rows.groupBy("agent_sk", "date_key")
            .agg(F.max_by(F.struct(*values), "as_of").alias("_last")).select("agent_sk", "date_key", "_last.*"))


def fold_daily_counts(wh: Warehouse, table: str = COUNTS) -> None:
    """All parts as one, in a new version: each agent-day's last totals with their ``as_of``.

    A micro-batch that is replayed after a fold writes totals no later than the folded
    ones, or the same, so reading is not changed by it.
    """
    rows = wh.read(table)
    if rows is not None:
        wh.rewrite(table, _last_totals(rows).withColumn("batch_id", F.lit(FOLDED)), ["batch_id"])


def read_daily_counts(wh: Warehouse, table: str = COUNTS) -> DataFrame:
    """Current agent x day counts by ``agent_sk``."""
    rows = wh.read(table)
    if rows is None:
        return wh.spark.createDataFrame([], "agent_sk long, date_key int, invites_sent long, invites_accepted long,"
                                            " messages_sent long, replies_received long")
    return _last_totals(rows).drop("as_of")


def stream_events_view(spark: SparkSession, src_dir: str) -> DataFrame:
    """The ``v_event`` projection over the streaming ``events`` files."""
    return events_view(read_event_stream(spark, src_dir, "events.parquet"))


__all__ = ["read_event_stream", "start_ingest", "start_daily_counts", "read_daily_counts",
           "fold_daily_counts", "stream_events_view"]
