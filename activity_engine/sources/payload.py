"""Batch event source (S1): the nested payload as four DataFrames.

A payload is a document with four record lists (agents, campaigns, leads,
activities). Reading goes through an explicit schema (no inference) and
``posexplode``, whose position becomes ``ingest_order`` for first-arrival
semantics. A missing list is an empty DataFrame. The lists are exploded side by
side, so that one parse of a document serves them all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.schemas import (ACTIVITY_BATCH, AGENT_RECORD, CAMPAIGN_RECORD,
                                     LEAD_RECORD, PAYLOAD)


@dataclass
class Payload:
    agents: DataFrame
    campaigns: DataFrame
    leads: DataFrame
    activities: DataFrame
    #: (record, file) of documents that could not be parsed; None where there are none to parse.
    corrupt: DataFrame | None = None
    #: What all of the above select from: with it cached, the documents are parsed once. None where
    #: each has a source of its own.
    records: DataFrame | None = None


#: Other names under which a source may send a field: (list, field) -> its names there.
FIELD_NAMES = {("agents", "profile_url"): ("linkedin_profile_url",)}


def payload_schema(names: dict[tuple[str, str], tuple[str, ...]]) -> T.StructType:
    """The payload's type, with every name a field may have, and the text of corrupt documents."""
    lists = []
    for f in PAYLOAD.fields:
        record = f.dataType.elementType
        more = [T.StructField(n, record[field].dataType) for (own, field), found in names.items() if own == f.name
                for n in found]
        lists.append(T.StructField(f.name, T.ArrayType(T.StructType([*record.fields, *more]))))
    return T.StructType([*lists, T.StructField("_corrupt", T.StringType())])


LISTS = {"agents": AGENT_RECORD, "campaigns": CAMPAIGN_RECORD, "leads": LEAD_RECORD, "activities": ACTIVITY_BATCH}


def _explode(raw: DataFrame, names) -> DataFrame:
    """One row for each position of a document: its record of each list, null where the list has none.

    The many activities come as columns, ``_activity`` says whether there is one, the
    other records as structs. The text of a corrupt document is at its first position.
    """
    def filled(c, dtype):
        return F.coalesce(c, F.array().cast(dtype))

    text = F.when(F.col("_corrupt").isNotNull(), F.array("_corrupt"))
    side_by_side = F.arrays_zip(*[filled(F.col(c), raw.schema[c].dataType).alias(c) for c in LISTS],
                                filled(text, "array<string>").alias("_corrupt"))
    rows = raw.select(F.col("_metadata.file_modification_time").alias("_time"),
                      F.col("_metadata.file_path").alias("_path"), F.posexplode(side_by_side).alias("_pos", "r"))
    return rows.select("_time", "_path", "_pos", "r._corrupt", *[f"r.{c}" for c in LISTS if c != "activities"],
                       F.col("r.activities").isNotNull().alias("_activity"),
                       *_values("activities", "r.activities", names))


def _values(field: str, record: str, names) -> list:
    """The fields of a list's record, each the first of its names that has a value."""
    return [F.coalesce(*[F.col(f"{record}.{n}") for n in (f.name, *names.get((field, f.name), ()))]).alias(f.name)
            for f in LISTS[field].fields]


def _records(rows: DataFrame, field: str, names) -> DataFrame:
    """The records of one list; ``ingest_order`` = (file time, file path, position)."""
    order = F.struct(F.col("_time").alias("t"), F.col("_path").alias("f"), F.col("_pos").alias("p"))
    if field == "activities":
        return rows.where("_activity").select(*LISTS[field].names, order.alias("ingest_order"))
    return rows.where(F.col(field).isNotNull()).select(*_values(field, field, names), order.alias("ingest_order"))


def read_payload(spark: SparkSession, path: str, multi_line: bool = True,
                 names: dict[tuple[str, str], tuple[str, ...]] | None = None) -> Payload:
    """Read JSON payload documents: one a file, or (``multi_line=False``) one a line.

    ``names`` says what else a field may be called in the source (``FIELD_NAMES`` if
    not given); the first name that has a value counts. Documents that are no JSON, or
    hold a value of another type, are in ``corrupt`` with their text; of the latter the
    lists hold what could be read.

    Arrival order is the file's modification time, then its path, then the
    record's position in its list: deterministic under task retries and
    computed per row, with no global numbering step.
    """
    names = FIELD_NAMES if names is None else names
    raw = (spark.read.schema(payload_schema(names)).option("multiLine", multi_line)
           .option("columnNameOfCorruptRecord", "_corrupt").json(path))
    rows = _explode(raw, names)
    corrupt = rows.where(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("record"), F.col("_path").alias("file"))
    return Payload(**{field: _records(rows, field, names) for field in LISTS}, corrupt=corrupt, records=rows)


def from_records(spark: SparkSession, agents=(), campaigns=(), leads=(), activities=()) -> Payload:
    """Payload from Python record lists (tests, small control batches)."""
    def mk(rows, schema):
        df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows],
                                   schema)
        return df.withColumn("ingest_order", F.monotonically_increasing_id())
    return Payload(mk(agents, AGENT_RECORD), mk(campaigns, CAMPAIGN_RECORD),
                   mk(leads, LEAD_RECORD), mk(activities, ACTIVITY_BATCH))


def read_activity_files(spark: SparkSession, path: str) -> DataFrame:
    """Flat activity batches stored as Parquet files (S1, non-nested form).

    Explicit schema (no inference; missing columns read as nulls). Arrival
    order is (file modification time, file path, row index in the file),
    all from the scan's file metadata: deterministic under task retries.
    """
    df = spark.read.schema(ACTIVITY_BATCH).parquet(path)
    order = F.struct(F.col("_metadata.file_modification_time").alias("t"),
                     F.col("_metadata.file_path").alias("f"),
                     F.col("_metadata.row_index").alias("r"))
    return df.select(*[f.name for f in ACTIVITY_BATCH.fields], order.alias("ingest_order"))
