"""Which event ids the fact holds (J4, T2): a narrow table of ids in hash buckets.

The fact's id column alone answers the question too, but its cost grows with the fact.
Here a load reads only the buckets that its own ids fall into and, of their files, the
row groups whose least and largest id enclose them (files are sorted by id; a load's new
ids are usually later than all before it, so that most footers rule their file out). A
bucket holds about ``ids_per_bucket`` ids however large the table: when it would hold
more, the table is written anew with four times the buckets, which costs a constant
share of every insert. So does folding the files of many small loads.

The state beside the table says how many buckets there are and whether an insert is
under way. A run that dies between its inserts into fact and index leaves it open, and
the next load builds the index from the fact again: ids are neither lost nor doubled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.sources.tables import Warehouse

IDS_PER_BUCKET = 1_000_000
#: Loads after which a bucket's files are folded, at least, and per bucket.
FOLD_AFTER, FOLD_PER_BUCKET = 64, 4


class EventIdIndex:
    def __init__(self, wh: Warehouse, fact: str = "fact_outreach_activity", table: str = "event_ids",
                 key: str = "event_id", ids_per_bucket: int = IDS_PER_BUCKET):
        self.wh, self.fact, self.table, self.key, self.ids_per_bucket = wh, fact, table, key, ids_per_bucket

    def _bucket(self, bits: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(1 << bits)).cast("int")

    def _write(self, ids: DataFrame, bits: int, anew: bool) -> None:
        keyed = ids.select(F.col(self.key).cast("string").alias(self.key)).withColumn("id_bucket", self._bucket(bits))
        placed = keyed.hint("rebalance", "id_bucket").sortWithinPartitions("id_bucket", self.key)
        (self.wh.rewrite if anew else self.wh.append)(self.table, placed, ["id_bucket"])

    # -- state ---------------------------------------------------------------------
    def state(self) -> dict:
        """The state of a usable index; one that is missing or was left open is built first."""
        state = self.wh.read_state(self.table)
        if state is None or state["open"]:
            self.rebuild()
            state = self.wh.read_state(self.table)
        return state

    def rebuild(self) -> None:
        """The index of all ids of the fact."""
        fact = self.wh.read(self.fact)
        state = {"bits": 0, "ids": 0, "appends": 0, "open": True}
        self.wh.write_state(self.table, state)
        if fact is None:
            if self.wh.read(self.table) is not None:       # ids of a load whose rows never came
                self.wh.rewrite(self.table, self.wh.read(self.table).limit(0), ["id_bucket"])
        else:
            self._lay_out(fact.select(self.key), fact.select(self.key).count(), state)
        self.wh.write_state(self.table, state | {"open": False})

    def _lay_out(self, ids: DataFrame, count: int, state: dict) -> None:
        state |= {"ids": count, "appends": 0}
        while count > self.ids_per_bucket << state["bits"]:
            state["bits"] += 2
        self._write(ids, state["bits"], anew=True)

    # -- use -----------------------------------------------------------------------
    def candidates(self, ids: DataFrame) -> DataFrame | None:
        """The stored ids that may be among ``ids``: their buckets, between their least and largest.

        The buckets are collected: there is one for each ``ids_per_bucket`` ids stored.
        """
        bits = self.state()["bits"]
        stored = self.wh.read(self.table)
        if stored is None:
            return None
        text = ids.select(F.col(self.key).cast("string").alias(self.key)).where(F.col(self.key).isNotNull())
        touched = (text.groupBy(self._bucket(bits).alias("bucket"))
                   .agg(F.min(self.key).alias("lo"), F.max(self.key).alias("hi")).collect())
        if not touched:
            return stored.limit(0).select(self.key)
        lo, hi = min(r.lo for r in touched), max(r.hi for r in touched)
        return stored.where(F.col("id_bucket").isin([r.bucket for r in touched])
                            & F.col(self.key).between(lo, hi)).select(self.key)

    def unseen(self, batch: DataFrame, ids: DataFrame | None = None) -> DataFrame:
        """Rows of the (deduped) batch whose id the fact does not hold.

        ``ids`` may be any superset of the batch's ids that is cheaper to read.
        """
        found = self.candidates(batch if ids is None else ids)
        if found is None:
            return batch
        return batch.join(found, batch[self.key].cast("string") == found[self.key], "left_anti")

    def insert(self, rows: DataFrame, count: int, write_fact) -> None:
        """Append ``rows`` (new ones, ``count`` of them) to the fact by ``write_fact`` and to the index."""
        state = self.state()
        self.wh.write_state(self.table, state | {"open": True})
        write_fact(rows)
        total, appends = state["ids"] + count, state["appends"] + 1
        crowded = total > self.ids_per_bucket << state["bits"]
        state |= {"ids": total, "appends": appends}
        if crowded or appends > max(FOLD_AFTER, FOLD_PER_BUCKET << state["bits"]):
            stored, ids = self.wh.read(self.table), rows.select(F.col(self.key).cast("string").alias(self.key))
            self._lay_out(ids if stored is None else stored.select(self.key).unionByName(ids), total, state)
            self.wh.vacuum(self.table, keep=2)
        else:
            self._write(rows.select(self.key), state["bits"], anew=False)
        self.wh.write_state(self.table, state | {"open": False})
