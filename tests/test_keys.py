"""Dense surrogate keys over many ranges, hot keys and nulls."""

import pytest
from pyspark.sql import functions as F

from activity_engine.operators.keys import assign_surrogate_keys


@pytest.mark.parametrize("ranges", [1, 2, 7, 10_000])
def test_dense_in_key_order(spark, ranges):
    df = spark.range(50_000).select(F.concat(F.lit("k"), F.sha1(F.col("id").cast("string"))).alias("k"))
    out = assign_surrogate_keys(df, "k", "sk", 10, ranges)
    got = [r.k for r in out.orderBy("sk").select("k").collect()]
    assert got == sorted(got)
    assert out.agg(F.min("sk"), F.max("sk"), F.countDistinct("sk")).first()[:] == (11, 50_010, 50_000)


def test_bounds_are_a_table_and_ranges_stay_small(spark):
    df = spark.range(50_000).select(F.sha1(F.col("id").cast("string")).alias("k"))
    from activity_engine.operators.keys import _in_range
    rows = df.withColumn("_place", F.struct(F.col("k").alias("key"), F.lit(0).cast("long").alias("tie")))
    sizes = _in_range(rows, 10_000).groupBy("_coarse", "_fine").count()
    n, largest = sizes.agg(F.count(F.lit(1)), F.max("count")).first()
    assert n > 5_000 and largest < 100
    plan = assign_surrogate_keys(df, "k", "sk", 0, 10_000)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000                              # no bound is written into it


def test_a_hot_key_fills_several_ranges_and_nulls_come_first(spark):
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 100 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("v"))
    out = assign_surrogate_keys(df, "k", "sk", 0, 16)
    rows = out.orderBy("sk").collect()
    assert [r.sk for r in rows] == list(range(1, 3_001))
    keys = [r.k for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or ""))
    assert {(r.k, r.v) for r in rows} == {(r.k, r.v) for r in df.collect()}
    again = {(r.v, r.sk) for r in assign_surrogate_keys(df.repartition(5), "k", "sk", 0, 16).collect()}
    assert again == {(r.v, r.sk) for r in rows}


def test_empty(spark):
    assert assign_surrogate_keys(spark.createDataFrame([], "k string"), "k", "sk").collect() == []


def test_staged_keys_are_those_of_the_ranges(spark, tmp_path):
    from activity_engine.operators.keys import staged_surrogate_keys

    def stage(rows):
        rows.write.parquet(path := str(tmp_path / f"k{len(list(tmp_path.iterdir()))}"))
        assert "_cuts" not in rows._jdf.queryExecution().toString()      # no row is compared with bounds
        return path

    df = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") * 7919 % 5000).cast("string")).alias("k"),
                                  F.col("id").alias("v")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = staged_surrogate_keys(stage, df, "k", "sk", F.lit(100)).collect()
        files = len([f for f in (tmp_path / "k0").iterdir() if f.suffix == ".parquet"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files > 1
    assert sorted(got) == sorted(assign_surrogate_keys(df, "k", "sk", 100).collect())
    assert [r.sk for r in sorted(got, key=lambda r: r.k)] == list(range(101, 5101))
    assert staged_surrogate_keys(stage, df.limit(0), "k", "sk").count() == 0


def test_small_cached_frames_have_few_partitions(spark):
    from activity_engine.session import ensure_session_conf
    ensure_session_conf(spark)
    df = spark.range(1000).select((F.col("id") % 101).alias("cached_key")).distinct().persist()
    try:
        assert df.groupBy().count().first()[0] == 101
        held = [r.numPartitions() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo() if "cached_key" in r.name()]
        assert held == [1]
    finally:
        df.unpersist(True)
