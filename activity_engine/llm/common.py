"""Helpers the corpus operators share: session settings, scratch tables, word hashing."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_engine.session import ensure_session_conf, scratch_path

#: Rows and bytes of one Arrow batch: a batch of long texts must stay small.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

#: Spark's setting by which a finished query's shuffle files are removed.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> None:
    ensure_session_conf(spark)
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per application.

    Spark itself hands the archive from the driver to every executor.
    """
    context, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    archive = f"{root.name}.zip"
    if archive in context._python_includes:
        return
    target = Path(tempfile.mkdtemp(prefix="ship-")) / archive
    with zipfile.ZipFile(target, "w") as z:
        for source in root.rglob("*.py"):
            z.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))


def materialize(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can read again after a loss. With
    ``drop_shuffles`` Spark removes the shuffle files of the write after it, which
    nothing reads any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true" if drop_shuffles else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(columns: list[str], base: str) -> str:
    """``base``, lengthened until no column has that name (in any case)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value's text modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def stratified_sample(df: DataFrame, stratum: str, id_col: str, per_stratum: int) -> DataFrame:
    """About ``per_stratum`` rows of each stratum, chosen by a hash of the id.

    The rate of a stratum is ``per_stratum`` over its row count, so the expected
    sample size is bounded whatever the input; hashing makes it reproducible.
    Rows whose stratum or id is null are left out.
    """
    known = df.filter(F.col(stratum).isNotNull()).select(F.col(stratum).alias("_stratum"), F.col(id_col).alias("_drawn"))
    rates = known.groupBy("_stratum").agg(F.count(F.lit(1)).alias("_rows"))
    slot = F.pmod(F.xxhash64("_drawn"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = known.join(rates, "_stratum").filter(slot * F.col("_rows") < F.lit(per_stratum)).select("_drawn").distinct()
    # The ids' number has that bound, so the wide rows need not be shuffled.
    return (df.filter(F.col(stratum).isNotNull())
            .join(F.broadcast(drawn), F.col(id_col) == F.col("_drawn")).drop("_drawn"))


class Cache(dict):
    """``cache[key]`` computes what it lacks.

    At ``limit`` entries a new generation begins; what is asked for again moves
    over from the last one, so frequent keys stay and memory is bounded.
    """

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self.make, self.limit, self.last = make, limit, {}

    def empty(self) -> None:
        self.last = {}
        self.clear()

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.last = dict(self)
            self.clear()
        value = self.last.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


#: What empties the stores that operators keep in a worker process, and the operator it serves.
_STORES: list[Callable[[], None]] = []
_SERVED: list = [None]


def stored(empty: Callable[[], None]) -> None:
    """``empty`` drops what a module keeps in the process; called when another operator begins there."""
    _STORES.append(empty)


def serve(operator: str) -> None:
    """Called by tasks before the work of ``operator``.

    Spark's worker processes serve one operator after the other; what the last one kept
    goes first, and its memory goes back to the system.
    """
    if _SERVED[0] == operator:
        return
    _SERVED[0] = operator
    for empty in _STORES:
        empty()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)


_WORD_HASH = Cache(xxhash.xxh3_64_intdigest)
stored(_WORD_HASH.empty)


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, as uint64."""
    return np.fromiter(map(_WORD_HASH.__getitem__, words), dtype=np.uint64, count=len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _FOLD
    x = (x ^ (x >> _HALF)) * _FOLD
    return x ^ (x >> _HALF)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (empty if there are fewer)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, np.uint64(n))
    for i in range(n):
        out = mix64(out * _MIX + hashes[i:i + count])
    return out
