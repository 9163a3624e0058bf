"""Surrogate keys (W10) and natural-key -> surrogate-key resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Most key ranges of one assignment, and rows sampled for the bounds of each.
MAX_RANGES = 65_536
SAMPLES_PER_RANGE = 8


def _range_bounds(rows: DataFrame, ranges: int) -> DataFrame:
    """Places that cut the rows into about equal ranges, two levels deep: few rows.

    The places with the least hashes, a bounded sample that depends on the data alone,
    every 8th of them in order. One row for each coarse range, of about the square root
    of ``ranges``: its number, its first place, and the places that cut it further.
    """
    drawn = (rows.select("_place").distinct().orderBy(F.xxhash64("_place"), "_place")
             .limit(SAMPLES_PER_RANGE * ranges))
    nth = F.row_number().over(Window.orderBy("_place"))
    cuts = (drawn.withColumn("_n", nth).where(F.col("_n") % SAMPLES_PER_RANGE == 0)
            .withColumn("_n", (F.col("_n") / SAMPLES_PER_RANGE - 1).cast("int")))
    width = max(1, round(ranges ** 0.5))
    return (cuts.groupBy(F.floor(F.col("_n") / width).cast("int").alias("_coarse"))
            .agg(F.min("_place").alias("_first"), F.array_sort(F.collect_list("_place")).alias("_cuts")))


def _in_range(rows: DataFrame, ranges: int) -> DataFrame:
    """Adds ``_coarse`` and ``_fine``, the number of the row's range.

    The first places, one array that a scalar subquery yields, find the coarse range, a
    join on it the cuts of the fine one: about 2 * sqrt(ranges) comparisons a row.
    """
    bounds = _range_bounds(rows, ranges)
    firsts = bounds.agg(F.array_sort(F.collect_list("_first"))).scalar()
    # At most ``ranges`` places in both together: sqrt(ranges) and ``ranges``.
    placed = (rows.withColumn("_firsts", firsts)
              .withColumn("_coarse", F.size(F.filter("_firsts", lambda c: c < F.col("_place"))) - 1).drop("_firsts"))
    return (placed.join(F.broadcast(bounds.select("_coarse", "_cuts")), "_coarse", "left")
            .withColumn("_fine", F.size(F.filter(F.coalesce("_cuts", F.array().cast(bounds.schema["_cuts"].dataType)),
                                                 lambda c: c < F.col("_place"))))
            .drop("_cuts"))


def assign_surrogate_keys(df: DataFrame, key_col: str, sk_col: str,
                          start_after: Column | int = 0,
                          num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start_after + 1 ..`` in natural-key order (autoincrement), nulls first.

    A global ``row_number()`` would sort everything in one task. Instead each row
    gets the number of its key range, its position inside the range, and the
    rows of the ranges before as offset. ``num_partitions`` ranges (the session's shuffle
    partitions, which follow the input size), at most ``MAX_RANGES``. A row's place is its
    key with a hash of the whole row, so a key with many rows fills several ranges; rows
    that are alike in every column share one. Bounds, range, position and offset are
    functions of the data: a recomputed task assigns the same ids, and nothing is
    checkpointed or collected.
    """
    spark = df.sparkSession
    ranges = max(1, min(MAX_RANGES, num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    place = F.struct(F.col(key_col).alias("key"), F.xxhash64(*[F.col(c) for c in df.columns]).alias("tie"))
    rows = _in_range(df.withColumn("_place", place), ranges)
    offsets = rows.groupBy("_coarse", "_fine").agg(F.count(F.lit(1)).alias("_n"))     # one row a range
    offsets = offsets.select(
        "_coarse", "_fine",
        F.coalesce(F.sum("_n").over(Window.orderBy("_coarse", "_fine").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    nth = F.row_number().over(Window.partitionBy("_coarse", "_fine").orderBy("_place"))
    return (rows.withColumn("_pos", nth).join(F.broadcast(offsets), ["_coarse", "_fine"])
            .withColumn(sk_col, (base + F.col("_off") + F.col("_pos")).cast("long"))
            .select(*df.columns, sk_col))


def staged_surrogate_keys(stage, df: DataFrame, key_col: str, sk_col: str, start_after: Column | int = 0) -> DataFrame:
    """The ids of ``assign_surrogate_keys`` for keys that are unique and not null, through a table.

    ``stage`` writes the rows, sorted by key, and returns the path of their Parquet files.
    Each file holds a run of the order, so an id is the row's place in its file after the
    rows of the files before: no row is compared with bounds, and ids come from what was
    written, so a recomputed task assigns the same.
    """
    path = stage(df.orderBy(key_col))
    rows = df.sparkSession.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_run"), F.col("_metadata.row_index").alias("_pos"))
    runs = rows.groupBy("_run").agg(F.min(key_col).alias("_first"), F.count(F.lit(1)).alias("_n"))    # one row a file
    runs = runs.select("_run", F.coalesce(F.sum("_n").over(Window.orderBy("_first").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    return (rows.join(F.broadcast(runs), "_run")
            .select(*df.columns, (base + F.col("_off") + F.col("_pos") + 1).cast("long").alias(sk_col)))


def resolve_keys(batch: DataFrame, agents: DataFrame, leads: DataFrame,
                 campaigns: DataFrame) -> DataFrame:
    """Left-join the batch to the three dimensions (J1); a miss leaves null.

    Only current agent versions resolve. Dimension sides are reduced to
    ``(natural key, surrogate key)`` so AQE can turn any of them into a
    broadcast join from runtime size; no hint is forced because dimensions
    grow with the data.
    """
    a = agents.where(F.col("is_current") == 1).select("agent_id", "agent_sk") \
        if "is_current" in agents.columns else agents.select("agent_id", "agent_sk")
    lk = leads.select("lead_id", "lead_sk")
    ck = campaigns.select("campaign_id", "campaign_sk")
    return (batch.join(a, "agent_id", "left")
            .join(lk, "lead_id", "left")
            .join(ck, "campaign_id", "left"))
