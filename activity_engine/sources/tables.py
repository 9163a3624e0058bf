"""Warehouse tables on Parquet.

Layout: ``<root>/<table>/<version>/`` with zero-padded versions. A version
is visible once Spark's job commit wrote its ``_SUCCESS`` marker, so a
failed or retried job never exposes partial files. Appends go into the
current version; rewrites (upsert, SCD2) go to a new version, which means a
plan may read the current version while writing the next one, with no
lineage cut needed and no overwrite of a path being read.

Paths are plain Hadoop URIs: on a cluster ``root`` is a shared folder
(HDFS, object store), never machine-local.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_engine.schemas import PLACING, TABLES, conform

VERSION_DIGITS = 6
LEDGERS = ("dq_audit_log", "pipeline_runs")


class Warehouse:
    """``catalog`` types the tables it names: they are written and read with its columns."""

    def __init__(self, spark: SparkSession, root: str, catalog: dict | None = None):
        self.spark = spark
        self.catalog = TABLES if catalog is None else catalog
        self.root = root.rstrip("/")
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    # -- paths and versions ------------------------------------------------------
    def _fs(self, path: str):
        p = self._Path(path)
        return p.getFileSystem(self._conf), p

    def table_dir(self, table: str) -> str:
        return f"{self.root}/{table}"

    def versions(self, table: str) -> list[int]:
        fs, p = self._fs(self.table_dir(table))
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.isdigit() and fs.exists(
                    self._Path(st.getPath(), "_SUCCESS")):
                out.append(int(name))
        return sorted(out)

    def _vpath(self, table: str, v: int) -> str:
        return f"{self.table_dir(table)}/{v:0{VERSION_DIGITS}d}"

    def current_path(self, table: str) -> str | None:
        vs = self.versions(table)
        return self._vpath(table, vs[-1]) if vs else None

    def exists(self, table: str) -> bool:
        return self.current_path(table) is not None

    # -- read / write ----------------------------------------------------------------
    def read(self, table: str, placing: list[str] | None = None) -> DataFrame | None:
        """The current version, or None if there is none. A table of the catalog has its
        columns and types whatever its files hold, and comes without those that place
        its rows (but for ``placing``); any other without rows is None (it has no files
        to read a type from)."""
        rows = self._read(table, placing or [])
        if rows is not None and "_marker" in rows.columns:
            rows = rows.where(~F.coalesce("_marker", F.lit(False))).drop("_marker", "_run")
        if rows is None or table not in self.catalog:
            return rows
        return rows.select(*self.catalog[table].names, *(placing or []))

    def _read(self, table: str, placing: list[str]) -> DataFrame | None:
        path = self.current_path(table)
        if not path:
            return None
        if table in self.catalog:
            extra = [*(["_marker"] if table in LEDGERS else []), *placing]
            extra = T.StructType.fromDDL(", ".join(f"{c} {PLACING[c]}" for c in extra)).fields if extra else []
            return self.spark.read.schema(T.StructType([*self.catalog[table].fields, *extra])).parquet(path)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):
                return None
            raise

    def _typed(self, table: str, df: DataFrame) -> DataFrame:
        return conform(df, self.catalog[table]) if table in self.catalog else df

    def create(self, table: str, partition_by: list[str] | None = None) -> None:
        """An empty table of the catalog, if there is none yet."""
        if not self.exists(table):
            rows = self.spark.createDataFrame([], self.catalog[table])
            placing = [c for c in partition_by or [] if c not in rows.columns]
            self.rewrite(table, rows.withColumns({c: F.lit(None).cast(PLACING[c]) for c in placing}), partition_by)

    def append(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        path = self.current_path(table) or self._vpath(table, 1)
        w = self._typed(table, df).write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def rewrite(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        """Write ``df`` as the next version (``df`` may read the current one)."""
        vs = self.versions(table)
        path = self._vpath(table, (vs[-1] + 1) if vs else 1)
        # A fresh directory: static mode, so the job commit writes _SUCCESS.
        w = self._typed(table, df).write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def overwrite_partitions(self, table: str, df: DataFrame, partition_col: str | list[str]) -> str:
        """Replace only the partitions present in ``df`` (dynamic overwrite).

        For derived tables recomputed from another table: ``df`` must not read
        the path it overwrites. The first write creates the version.
        """
        path = self.current_path(table)
        by = [partition_col] if isinstance(partition_col, str) else partition_col
        if path is None:
            return self.rewrite(table, df, by)
        (self._typed(table, df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))
        return path

    # -- small state beside a table ----------------------------------------------------
    def read_state(self, table: str) -> dict | None:
        """The table's state, or None if there is none that can be read."""
        fs, p = self._fs(f"{self.table_dir(table)}/_state.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:                     # a write was cut short
            return None

    def write_state(self, table: str, state: dict) -> None:
        fs, p = self._fs(f"{self.table_dir(table)}/_state.json")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()

    def vacuum(self, table: str, keep: int = 2) -> list[str]:
        """Delete committed versions older than the newest ``keep``.

        Not called by the pipeline: run it when no reader still uses an old
        version (readers resolve the newest version when they start).
        """
        keep = max(1, keep)
        removed = []
        for v in self.versions(table)[:-keep]:
            fs, p = self._fs(self._vpath(table, v))
            fs.delete(p, True)
            removed.append(str(p))
        return removed
