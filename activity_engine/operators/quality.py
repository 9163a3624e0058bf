"""Five-dimension data-quality scoring of a batch.

Each check returns a one-row DataFrame ``(dimension, records_evaluated,
records_failed, dimension_score, details)``. ``evaluate_batch`` computes
completeness and timeliness in one aggregate pass, uniqueness, validity and
referential integrity in one aggregate of all keys, and adds the weighted
composite. Only counts and at most ``sample_size`` sample keys per check ever
reach a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.config import DQConfig
from activity_engine.functions.dates import to_event_ts
from activity_engine.functions.numeric import clamp_score, np_round
from activity_engine.operators.ingest import key_hash


def _part(df: DataFrame, dimension: str, n=None, failed=None, details=None,
          cells=None) -> DataFrame:
    """One partial row of a dimension; partial rows are merged by ``_merge``."""
    return df.select(*_part_columns(dimension, n, failed, details, cells))


def _part_columns(dimension: str, n=None, failed=None, details=None, cells=None) -> list[Column]:
    nul = F.lit(None)
    return [F.lit(dimension).alias("dimension"),
            (n if n is not None else nul).cast("long").alias("n"),
            (failed if failed is not None else F.lit(0)).cast("long").alias("f"),
            (details if details is not None else nul).cast("string").alias("details"),
            (cells if cells is not None else (n if n is not None else nul)).cast("long").alias("cells")]


def _parts(df: DataFrame, *parts: list[Column]) -> DataFrame:
    """Several partial rows from one aggregate row, which is computed once."""
    return df.select(F.explode(F.array(*[F.struct(*p) for p in parts])).alias("_p")).select("_p.*")


def _merge(parts: list[DataFrame]) -> DataFrame:
    """Union partial rows and fold them per dimension (no joins needed)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    g = u.groupBy("dimension").agg(F.coalesce(F.max("n"), F.lit(0)).alias("records_evaluated"),
                                   F.coalesce(F.sum("f"), F.lit(0)).alias("records_failed"),
                                   F.max("details").alias("details"),
                                   F.coalesce(F.max("cells"), F.lit(0)).alias("_cells"))
    return g.withColumn("dimension_score", clamp_score("records_failed", "_cells")).drop("_cells")


def invalid_flag(col: str, allowed) -> Column:
    """outside the domain; a null is invalid too (bare ``~isin`` drops it)."""
    return ~F.coalesce(F.col(col).isin(list(allowed)), F.lit(False))


def _sample_part(keys: DataFrame, col: str, k: int, dimension: str, wrap: str | None = None) -> DataFrame:
    """Up to ``k`` smallest values as a JSON array (TakeOrdered, bounded)."""
    arr = F.to_json(F.coalesce(F.collect_list("v"), F.array()))
    if wrap:
        arr = F.to_json(F.struct(F.coalesce(F.collect_list("v"), F.array()).alias(wrap)))
    s = (keys.select(F.col(col).cast("string").alias("v")).orderBy(F.col("v").asc_nulls_first())
         .limit(k).agg(arr.alias("d")))
    return _part(s, dimension, details=F.col("d"))


# -- single checks -----------------------------------------------------------

def completeness_counts(df: DataFrame, required) -> list[Column]:
    """Per-column null counts; an absent column counts every row as missing."""
    n = F.count(F.lit(1))
    return [(F.count_if(F.col(c).isNull()) if c in df.columns else n).alias(f"miss_{c}")
            for c in required]


def _completeness_part(required) -> list[Column]:
    miss = [F.col(f"miss_{c}") for c in required]
    total = miss[0]
    for m in miss[1:]:
        total = total + m
    details = F.when(F.col("n") == 0, F.lit("{}")).otherwise(
        F.to_json(F.struct(*[F.col(f"miss_{c}").alias(c) for c in required])))
    # Scored over cells (rows x required columns); records_evaluated is rows.
    return _part_columns("COMPLETENESS", F.col("n"), total, details,
                         cells=F.col("n") * F.lit(len(required)))


def check_completeness(df: DataFrame, required) -> DataFrame:
    """A2: missing cells over ``rows × required columns``."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), *completeness_counts(df, required))
    return _merge([_parts(agg, _completeness_part(required))])


def _uniqueness_parts(df: DataFrame, key, sample_size: int) -> list[DataFrame]:
    keys = [key] if isinstance(key, str) else list(key)
    if any(k not in df.columns for k in keys):
        return [_part(df.sparkSession.range(1), "UNIQUENESS", F.lit(0), F.lit(0), F.lit("[]"))]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    agg = groups.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
                     F.coalesce(F.sum(F.when(F.col("c") > 1, F.col("c"))), F.lit(0)).alias("f"))
    label = F.col(keys[0]).cast("string") if len(keys) == 1 else \
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    dup = groups.where(F.col("c") > 1).select(label.alias("k"))
    return [_part(agg, "UNIQUENESS", F.col("n"), F.col("f")),
            _sample_part(dup, "k", sample_size, "UNIQUENESS")]


def check_uniqueness(df: DataFrame, key, sample_size: int = 5) -> DataFrame:
    """A3: rows that share their key with another row (every copy counts).

    The per-key counts are combined map-side, so a key holding a third of
    the rows costs one partial count per task, not a third of the data in
    one task.
    """
    return _merge(_uniqueness_parts(df, key, sample_size))


def invalid_values(df: DataFrame, col: str = "event_type", allowed=None) -> DataFrame:
    """All distinct out-of-domain values with their row counts (distributed)."""
    allowed = allowed or DQConfig().allowed_event_types
    return (df.where(invalid_flag(col, allowed)).groupBy(col)
            .agg(F.count(F.lit(1)).alias("rows")))


def check_validity(df: DataFrame, col: str = "event_type", allowed=None,
                   sample_size: int = 5) -> DataFrame:
    """A4: rows whose value is outside the allowed domain.

    Details hold up to ``sample_size`` distinct invalid values; the full
    list is ``invalid_values`` (a DataFrame, never collected).
    """
    allowed = allowed or DQConfig().allowed_event_types
    if col not in df.columns:
        return _merge([_part(df.sparkSession.range(1), "VALIDITY", F.lit(0), F.lit(0),
                             F.lit("{}"))])
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(invalid_flag(col, allowed)).alias("f"))
    return _merge([_part(agg, "VALIDITY", F.col("n"), F.col("f")),
                   _sample_part(invalid_values(df, col, allowed), col, sample_size,
                                "VALIDITY", wrap="invalid_event_types")])


def timeliness_counts(df: DataFrame, col: str, now: Column, min_ts: Column) -> list[Column]:
    ts = to_event_ts(col, df.schema[col].dataType)
    return [F.count_if(ts > now).alias("future_events"),
            F.count_if(ts < min_ts).alias("stale_events"),
            F.count_if(ts.isNull()).alias("unparseable_dates")]


def _timeliness_part() -> list[Column]:
    f = F.col("future_events") + F.col("stale_events") + F.col("unparseable_dates")
    det = F.to_json(F.struct("future_events", "stale_events", "unparseable_dates"))
    return _part_columns("TIMELINESS", F.col("n"), f, det)


def check_timeliness(df: DataFrame, col: str = "event_timestamp", now: Column | str | None = None,
                     min_ts: Column | str | None = None) -> DataFrame:
    """A5: future, stale (before ``min_ts``) and unparseable timestamps."""
    now, min_ts = _ts_lit(now, True), _ts_lit(min_ts or DQConfig().min_event_ts)
    if col not in df.columns:
        return _merge([_part(df.sparkSession.range(1), "TIMELINESS", F.lit(0), F.lit(0),
                             F.lit("{}"))])
    agg = df.agg(F.count(F.lit(1)).alias("n"), *timeliness_counts(df, col, now, min_ts))
    return _merge([_parts(agg, _timeliness_part())])


def _ts_lit(v, is_now: bool = False) -> Column:
    if v is None:
        return F.current_timestamp() if is_now else F.lit(None).cast("timestamp")
    return v if isinstance(v, Column) else F.to_timestamp(F.lit(v))


def unresolved_keys(df: DataFrame, col: str, parent: DataFrame, parent_col: str | None = None) -> DataFrame:
    """Distinct batch keys absent from the parent (all versions).

    A null key never matches, so it survives as one unresolved value, the
    same as a pandas ``unique()`` over the non-matching rows.
    """
    pc = parent_col or col
    p = parent.select(F.col(pc).alias(col)).distinct()
    return df.select(col).distinct().join(p, col, "left_anti")


def _referential_parts(df: DataFrame, agents, campaigns, sample_size: int) -> list[DataFrame]:
    parts = [_part(df.agg(F.count(F.lit(1)).alias("n")), "REFERENTIAL_INTEGRITY", F.col("n"))]
    samples = None
    for col, parent in (("agent_id", agents), ("campaign_id", campaigns)):
        if col in df.columns and parent is not None:
            miss = unresolved_keys(df, col, parent)
            parts.append(_part(miss.agg(F.count(F.lit(1)).alias("f")), "REFERENTIAL_INTEGRITY",
                               failed=F.col("f")))
            s = (miss.select(F.col(col).cast("string").alias("sample"))
                 .orderBy(F.col("sample").asc_nulls_first()).limit(sample_size)
                 .select(F.lit(f"unresolved_{col}s").alias("k"), "sample"))
            samples = s if samples is None else samples.unionByName(s)
    if samples is not None:
        # {"unresolved_agent_ids": [...], "unresolved_campaign_ids": [...]}, a
        # key only when something is unresolved; at most sample_size each.
        per_key = samples.groupBy("k").agg(F.sort_array(F.collect_list("sample")).alias("v"))
        det = per_key.agg(F.to_json(F.map_from_entries(F.array_sort(
            F.collect_list(F.struct("k", "v"))))).alias("d"))
        parts.append(_part(det, "REFERENTIAL_INTEGRITY",
                           details=F.coalesce(F.col("d"), F.lit("{}"))))
    return parts


def check_referential(df: DataFrame, agents: DataFrame | None, campaigns: DataFrame | None,
                      sample_size: int = 5) -> DataFrame:
    """Number of distinct unresolved agent ids plus campaign ids."""
    return _merge(_referential_parts(df, agents, campaigns, sample_size))


def referential_samples(df: DataFrame, agents: DataFrame, campaigns: DataFrame,
                        sample_size: int = 5) -> DataFrame:
    """A10: up to ``sample_size`` smallest unresolved ids per key column."""
    out = None
    for col, parent in (("agent_id", agents), ("campaign_id", campaigns)):
        s = (unresolved_keys(df, col, parent).select(F.col(col).cast("string").alias("sample"))
             .orderBy(F.col("sample").asc_nulls_first()).limit(sample_size)
             .select(F.lit(col).alias("key_column"), "sample"))
        out = s if out is None else out.unionByName(s)
    return out


# -- full evaluation ---------------------------------------------------------

def evaluate_batch(df: DataFrame, agents: DataFrame | None, campaigns: DataFrame | None,
                   table_name: str, run_id: str, now: Column | str | None = None,
                   cfg: DQConfig = DQConfig(), key: str = "event_id",
                   ts_col: str = "event_timestamp", type_col: str = "event_type",
                   kept: list[DataFrame] | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """A8 + A7 + U2: the five audit rows with the weighted composite.

    Completeness, timeliness and the row count come from one aggregate row, everything
    that looks at keys from one aggregate of (kind, value). Their totals and samples meet
    in one row, which is exploded into the five dimensions: two scans, one exchange of
    keys, whatever the number of checks. Spark does not share that exchange where ``df`` is
    cached: with ``kept`` the aggregate is cached too and added there, for the caller to
    release once the rows are read. With ``repeated``, the ``repeated_hashes`` of the key,
    only the keys that may have several rows go through that aggregate.
    """
    now_c = _ts_lit(now, True)
    min_c = _ts_lit(cfg.min_event_ts)
    has_key = all(c in df.columns for c in ([key] if isinstance(key, str) else key))
    has_type, has_ts = type_col in df.columns, ts_col in df.columns
    aggs = [F.count(F.lit(1)).alias("n"), *completeness_counts(df, cfg.required_columns)]
    if has_ts:
        aggs.extend(timeliness_counts(df, ts_col, now_c, min_c))
    flat = df.agg(*aggs)
    groups = _key_groups(df, agents, campaigns, key if has_key else None, type_col, cfg, repeated)
    one = flat
    if groups is not None and kept is not None:
        kept.append(groups.persist())
    if groups is not None:
        failed = groups.agg(F.coalesce(F.sum(F.when(F.col("kind") == KEY, F.col("bad_rows"))), F.lit(0)).alias("copies"),
                            F.coalesce(F.sum(F.when(F.col("kind") == TYPE, F.col("bad_rows"))), F.lit(0)).alias("invalid"),
                            F.count_if(F.col("kind").isin(AGENT, CAMPAIGN) & (F.col("bad_rows") > 0)).alias("unresolved"))
        rank = F.row_number().over(Window.partitionBy("kind").orderBy(F.col("value").asc_nulls_first()))
        samples = (groups.where(F.col("bad_rows") > 0).withColumn("rank", rank)
                   .where(F.col("rank") <= cfg.sample_size).select("kind", "value"))
        parts = flat.unionByName(failed, True).unionByName(samples, True)
        one = parts.agg(*[F.max(c).alias(c) for c in (*flat.columns, *failed.columns)],
                        *[_sampled(kind, label) for kind, label in SAMPLED.items()])
    else:
        one = flat.select("*", *[F.lit(0).alias(c) for c in ("copies", "invalid", "unresolved")],
                          *[F.array().cast("array<string>").alias(label) for label in SAMPLED.values()])
    key_label = F.col("keys") if isinstance(key, str) else F.transform(
        "keys", lambda v: F.concat_ws("|", F.from_json(v, "array<string>")))
    unresolved = F.map_filter(F.create_map(F.lit("unresolved_agent_ids"), F.col("agents"),
                                           F.lit("unresolved_campaign_ids"), F.col("campaigns")),
                              lambda k, v: F.size(v) > 0)
    rows = _parts(
        one, _completeness_part(cfg.required_columns),
        _part_columns("UNIQUENESS", F.col("n") if has_key else F.lit(0), F.col("copies"),
                      F.to_json(F.array_compact(key_label))),
        _part_columns("VALIDITY", F.col("n"), F.col("invalid"),
                      F.to_json(F.struct(F.array_compact("types").alias("invalid_event_types"))) if has_type else F.lit("{}")),
        _timeliness_part() if has_ts else _part_columns("TIMELINESS", F.col("n"), F.lit(0), F.lit("{}")),
        _part_columns("REFERENTIAL_INTEGRITY", F.col("n"), F.col("unresolved"),
                      F.to_json(F.transform_values(unresolved, lambda k, v: F.array_compact(v)))))
    rows = rows.select("dimension", F.col("n").alias("records_evaluated"), F.col("f").alias("records_failed"),
                       clamp_score("f", "cells").alias("dimension_score"), "details")
    return with_composite(rows, cfg).select(
        F.lit(run_id).alias("pipeline_run_id"), now_c.alias("check_timestamp"),
        F.lit(table_name).alias("table_name"), "dimension",
        F.col("records_evaluated").cast("long").alias("records_evaluated"),
        "records_failed", "dimension_score", "composite_score", "passed", "details")


#: What a value of the exploded key checks is: a key, an event type, an agent, a campaign.
KEY, TYPE, AGENT, CAMPAIGN = range(4)
SAMPLED = {KEY: "keys", TYPE: "types", AGENT: "agents", CAMPAIGN: "campaigns"}


def _key_groups(df: DataFrame, agents: DataFrame | None, campaigns: DataFrame | None, key,
                type_col: str, cfg: DQConfig, repeated: DataFrame | None = None) -> DataFrame | None:
    """Every key check in one aggregate: a row for each distinct (kind, value) that fails its check.

    Each event gives one value a kind, each parent row its id with zero rows, so the
    group of an id knows both its events and whether a parent has it: no join, and a hot
    value is combined before the shuffle. Values are compared as text. ``bad_rows`` are
    the rows of a value; a null id never resolves.
    """
    kinds = []
    if key is not None:
        text = F.col(key).cast("string") if isinstance(key, str) else F.to_json(
            F.array(*[F.col(k).cast("string") for k in key]), {"ignoreNullFields": "false"})
        kinds.append((KEY, text))
    if type_col in df.columns:
        kinds.append((TYPE, F.col(type_col).cast("string")))
    parents = [(kind, col, table) for kind, col, table in
               ((AGENT, "agent_id", agents), (CAMPAIGN, "campaign_id", campaigns))
               if col in df.columns and table is not None]
    kinds += [(kind, F.col(col).cast("string")) for kind, col, _ in parents]
    if not kinds:
        return None
    one = F.lit(1).cast("long").alias("rows")
    apart = None
    if repeated is not None and isinstance(key, str):
        apart = df.select(F.lit(KEY).alias("kind"), F.col(key).cast("string").alias("value"), one,
                          key_hash(key).alias("_hash")).join(repeated, "_hash", "left_semi").drop("_hash")
        kinds = kinds[1:]
    values = apart
    if kinds:
        values = df.select(F.explode(F.array(*[
            F.struct(F.lit(kind).alias("kind"), text.alias("value")) for kind, text in kinds])).alias("v")) \
            .select("v.kind", "v.value", one)
        values = values if apart is None else values.unionByName(apart)
    for kind, col, table in parents:
        values = values.unionByName(table.select(
            F.lit(kind).alias("kind"), F.col(col).cast(df.schema[col].dataType).cast("string").alias("value"),
            F.lit(0).cast("long").alias("rows")))
    groups = values.groupBy("kind", "value").agg(F.sum("rows").alias("rows"),
                                                 F.min("rows").alias("least"))   # 0: a parent has it
    bad = (F.when(F.col("kind") == KEY, F.col("rows") > 1)
           .when(F.col("kind") == TYPE, invalid_flag("value", cfg.allowed_event_types))
           .otherwise(F.col("value").isNull() | (F.col("least") > 0)))
    return groups.where(bad & (F.col("rows") > 0)).select("kind", "value", F.col("rows").alias("bad_rows"))


def _sampled(kind: int, label: str) -> Column:
    """The sample values of one kind, a null as such: at most ``sample_size`` reach it."""
    return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("value")))).getField("value").alias(label)


def with_composite(rows: DataFrame, cfg: DQConfig = DQConfig()) -> DataFrame:
    """Weighted sum of the five rounded scores, in a fixed order.

    The window has no partition key on purpose: it spans exactly the five
    dimension rows.
    """
    w = Window.partitionBy()
    order = (("COMPLETENESS", "completeness"), ("UNIQUENESS", "uniqueness"),
             ("VALIDITY", "validity"), ("REFERENTIAL_INTEGRITY", "referential_integrity"),
             ("TIMELINESS", "timeliness"))
    total = None
    for dim, wkey in order:
        s = F.coalesce(F.max(F.when(F.col("dimension") == dim, F.col("dimension_score"))).over(w),
                       F.lit(100.0)) * F.lit(cfg.weights[wkey])
        total = s if total is None else total + s
    comp = np_round(total, 2)
    return rows.withColumn("composite_score", comp).withColumn(
        "passed", (F.col("composite_score") >= F.lit(cfg.pass_threshold)).cast("int"))
