"""Calendar and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(d) -> Column:
    """YYYYMMDD integer key of a date or timestamp, by arithmetic."""
    d = F.to_date(_c(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def to_event_ts(col, dtype: T.DataType | None = None) -> Column:
    """Parse an event time to a UTC ``timestamp``.

    Strings go through ``try_to_timestamp`` so bad text becomes null instead
    of failing the job under ANSI mode; ``timestamp_ntz`` is re-typed so that
    watermarks and comparisons work.
    """
    c = _c(col)
    if dtype is None or isinstance(dtype, T.StringType):
        return F.try_to_timestamp(c)
    return c.cast("timestamp")


def date_parts(d) -> list[Column]:
    """The calendar attributes of one day."""
    d = _c(d)
    dow = (F.weekday(d) + 1).cast("int")  # ISO weekday, 1 = Monday
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.month(d).cast("int").alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("int").alias("quarter"),
        F.year(d).cast("int").alias("year"),
        F.when(dow.isin(6, 7), 1).otherwise(0).alias("is_weekend"),
    ]


def calendar(spark: SparkSession, start, end=None) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive.

    ``start``/``end`` are literals or a one-row DataFrame with columns
    ``start``/``end``. Size is bounded by the range, never by the fact.
    """
    if isinstance(start, DataFrame):
        bounds = start
    else:
        bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start"),
                                       F.to_date(F.lit(end)).alias("end"))
    days = bounds.select(F.explode(F.sequence(F.col("start"), F.col("end"),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*date_parts("d"))
