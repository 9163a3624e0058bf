from activity_engine.functions.dates import calendar


def test_calendar_range_and_parts(spark):
    cal = calendar(spark, "2025-01-01", "2027-12-31")
    assert cal.count() == 1095
    r = {x.date_key: x for x in cal.where("date_key in (20250101, 20250104, 20251231)").collect()}
    assert r[20250101].day_of_week == 3 and r[20250101].day_name == "Wednesday"
    assert r[20250104].is_weekend == 1
    assert r[20251231].quarter == 4 and r[20251231].month_name == "December"


def test_scale_conf_sizes_partitions():
    from activity_engine.session import scale_conf
    c = scale_conf(100 * 10**12, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 100 * 10**12 // (256 << 20)
    small = scale_conf(10**6, executors=2)
    assert int(small["spark.sql.shuffle.partitions"]) == 24
