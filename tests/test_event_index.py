"""The index of event ids: what it finds, what it reads, and what it survives."""

import uuid

import pytest
from pyspark.sql import functions as F

from activity_engine.sources.event_index import EventIdIndex
from activity_engine.sources.tables import Warehouse


@pytest.fixture()
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / uuid.uuid4().hex))


def ids(spark, *numbers):
    return spark.createDataFrame([(f"E{n:06d}", 20260801 + n % 3) for n in numbers], "event_id string, date_key int")


def load(wh, index, batch):
    new = index.unseen(batch)
    count = new.count()
    if count:
        index.insert(new.cache(), count, lambda r: wh.append("fact_outreach_activity", r, ["date_key"]))
    return count


def bytes_read(spark, df):
    """Bytes of the files that the scan of ``df`` opens."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = df.select("*")
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        return sum(leaves.apply(i).metrics().apply("filesSize").value() for i in range(leaves.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_loads_insert_each_id_once(spark, wh):
    index = EventIdIndex(wh, ids_per_bucket=50)
    assert load(wh, index, ids(spark, *range(40))) == 40
    assert load(wh, index, ids(spark, *range(20, 300))) == 260      # grows past its buckets
    assert index.state() == {"bits": 4, "ids": 300, "appends": 0, "open": False}
    assert load(wh, index, ids(spark, *range(300))) == 0
    assert load(wh, index, ids(spark, 7, 299, 300)) == 1
    fact = wh.read("fact_outreach_activity")
    assert fact.count() == 301 == fact.select("event_id").distinct().count()
    assert sorted(r.event_id for r in wh.read("event_ids").collect()) == sorted(r.event_id for r in fact.collect())


def test_a_small_batch_reads_as_much_from_a_large_fact(spark, wh, tmp_path):
    read = {}
    for size in (2_000, 32_000):
        w = Warehouse(spark, str(tmp_path / f"wh-{size}"))
        index = EventIdIndex(w, ids_per_bucket=500)
        fact = spark.range(size).select(F.format_string("E%06d", "id").alias("event_id"), F.lit(20260801).alias("date_key"))
        w.append("fact_outreach_activity", fact, ["date_key"])
        batch = ids(spark, 5, 900, 1500)
        assert load(w, index, batch) == 0
        read[size] = bytes_read(spark, index.candidates(batch))
        whole = bytes_read(spark, w.read("event_ids"))
        assert 0 < read[size] < whole
    assert read[32_000] < 2 * read[2_000]


def test_ids_past_all_others_match_no_row_group(spark, wh):
    index = EventIdIndex(wh)
    load(wh, index, ids(spark, *range(500)))
    late = index.candidates(ids(spark, *range(1000, 1010)))
    assert late.count() == 0
    assert "GreaterThanOrEqual(event_id" in late._jdf.queryExecution().executedPlan().toString()


def test_a_load_that_died_is_repaired(spark, wh):
    index = EventIdIndex(wh)
    load(wh, index, ids(spark, 1, 2))

    def died(_):
        raise RuntimeError("lost")

    for write in (died, lambda r: (wh.append("fact_outreach_activity", r, ["date_key"]), died(r))):
        with pytest.raises(RuntimeError):                             # before, and after the fact's append
            index.insert(ids(spark, 3), 1, write)
        assert wh.read_state("event_ids")["open"]
        assert load(wh, index, ids(spark, 1, 2, 3)) == (1 if write is died else 0)
        spark.catalog.clearCache()
        assert wh.read("fact_outreach_activity").count() == 3
        if write is died:
            rest = wh.read("fact_outreach_activity").where("event_id <> 'E000003'")
            wh.rewrite("fact_outreach_activity", rest, ["date_key"])
            index.rebuild()


def test_many_small_loads_are_folded(spark, wh, monkeypatch):
    monkeypatch.setattr("activity_engine.sources.event_index.FOLD_AFTER", 2)
    index = EventIdIndex(wh)
    for n in range(7):
        assert load(wh, index, ids(spark, n)) == 1
    assert index.state()["appends"] <= 4 and wh.read("event_ids").count() == 7
    assert load(wh, index, ids(spark, *range(7))) == 0


def test_null_ids_and_empty_batches(spark, wh):
    index = EventIdIndex(wh)
    assert load(wh, index, ids(spark)) == 0
    load(wh, index, ids(spark, 1))
    assert index.unseen(ids(spark).union(spark.createDataFrame([(None, 1)], "event_id string, date_key int"))).count() == 1


def test_a_load_that_grows_the_buckets_writes_its_ids_once(spark, wh):
    index = EventIdIndex(wh, ids_per_bucket=50)
    written = []
    write = index._write
    index._write = lambda ids, bits, anew: (written.append((ids.count(), bits, anew)), write(ids, bits, anew))
    assert load(wh, index, ids(spark, *range(300))) == 300
    assert load(wh, index, ids(spark, *range(310))) == 10
    assert written == [(300, 4, True), (10, 4, False)]
    assert wh.read("event_ids").select("event_id").distinct().count() == 310 == wh.read("event_ids").count()
