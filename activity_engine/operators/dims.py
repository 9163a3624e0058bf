"""Dimension maintenance: insert-if-absent (J5, J6), SCD2 (J7, X5) and keyed
upsert (J8, S8).

All of them are anti/left joins on the natural key plus unions; the caller
writes the result (append for inserts, versioned overwrite for rewrites).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.operators.ingest import dedupe_first_wins
from activity_engine.operators.keys import assign_surrogate_keys


def _first_per_key(incoming: DataFrame, key: str, order_col: str | None) -> DataFrame:
    """One record per natural key; the first arrival wins when an order exists."""
    if order_col and order_col in incoming.columns:
        return dedupe_first_wins(incoming, key, order_col)
    # Without an arrival order, pick deterministically: smallest row hash.
    tmp = incoming.withColumn("_o", F.xxhash64(*[F.col(c) for c in incoming.columns]))
    return dedupe_first_wins(tmp, key, "_o").drop("_o")


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: str, sk_col: str,
                     current_only: bool = False, order_col: str | None = None,
                     number=assign_surrogate_keys) -> DataFrame:
    """New rows for natural keys not yet in the dimension.

    With ``current_only`` (agents) a key counts as present only if it has a
    current version. New rows get dense keys after the current maximum; ``number``
    assigns them.
    """
    ex = existing.where(F.col("is_current") == 1) if current_only else existing
    fresh = _first_per_key(incoming.where(F.col(key).isNotNull()), key, order_col) \
        .join(ex.select(key), key, "left_anti")
    start = existing.select(F.coalesce(F.max(sk_col), F.lit(0))).scalar()
    return number(fresh, key, sk_col, start)


def changed_flag(old_prefix: str, new_prefix: str, cols: list[str]) -> Column:
    """Null-safe "any tracked column differs"."""
    diff = F.lit(False)
    for c in cols:
        diff = diff | ~F.col(f"{old_prefix}{c}").eqNullSafe(F.col(f"{new_prefix}{c}"))
    return diff


def scd2_merge(dim: DataFrame, incoming: DataFrame, key: str, sk_col: str,
               track: list[str], now: Column, order_col: str | None = None) -> DataFrame:
    """Close changed current versions and open new ones.

    Returns the whole new dimension: history and unchanged rows as they
    were, changed current rows closed (``end_date = now, is_current = 0``),
    and new versions for changed and unseen keys with fresh dense keys.
    One full outer join of current versions with the incoming records
    classifies every key; a version whose ``is_current`` is null is history.
    """
    inc = _first_per_key(incoming.where(F.col(key).isNotNull()), key, order_col)
    cur = dim.where(F.col("is_current") == 1)
    hist = dim.where(~F.coalesce(F.col("is_current") == 1, F.lit(False)))
    attrs = [c for c in inc.columns if c != key]
    n = inc.select(key, *[F.col(c).alias(f"_n_{c}") for c in attrs],
                   F.lit(True).alias("_in_new"))
    c = cur.withColumn("_in_cur", F.lit(True))
    j = c.join(n, key, "full_outer")
    in_cur = F.coalesce(F.col("_in_cur"), F.lit(False))
    in_new = F.coalesce(F.col("_in_new"), F.lit(False))
    changed = in_cur & in_new & changed_flag("", "_n_", track)
    old_rows = j.where(in_cur).select(*[
        (F.when(changed, now).otherwise(F.col(c)).alias(c) if c == "end_date" else
         F.when(changed, F.lit(0)).otherwise(F.col(c)).alias(c) if c == "is_current" else
         F.col(c)) for c in dim.columns])
    fresh = j.where(changed | (in_new & ~in_cur)).select(
        key, *[F.col(f"_n_{c}").alias(c) for c in attrs])
    start = dim.select(F.coalesce(F.max(sk_col), F.lit(0))).scalar()
    new_rows = assign_surrogate_keys(fresh, key, sk_col, start)
    new_rows = new_rows.select(*[
        (F.col(c) if c in new_rows.columns and c not in ("effective_date", "end_date",
                                                          "is_current") else
         now.alias(c) if c == "effective_date" else
         F.lit(None).cast("timestamp").alias(c) if c == "end_date" else
         F.lit(1).alias(c) if c == "is_current" else
         F.lit(None).cast(dim.schema[c].dataType).alias(c)) for c in dim.columns])
    return hist.unionByName(old_rows).unionByName(new_rows)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``updates`` replace same-key rows of ``target``."""
    return target.join(updates.select(*keys), keys, "left_anti") \
        .unionByName(updates.select(*target.columns))
