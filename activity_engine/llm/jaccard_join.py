"""N-gram Jaccard join by MinHash banding (operator 7).

Documents with equal shingle sets form a copy class (found by a hash of the set,
counted map-side); only one row a class goes on. Bands and rows are chosen for a
target recall at the threshold. Classes that share a band hash are linked to the
least class of that band, and the components of these star edges are the groups
in which pairs are verified on their full shingle sets. A group of more than
``BLOCK`` classes is cut into blocks by a hash of the class; each pair of blocks is
one task's work, which emits counts and spanning edges, never pairs. So a class is
sent once for each block of its group, and a task holds two blocks.

Shingles are ``n`` consecutive words (white-space separated, A-Z lowered); a text of
fewer words, but not none, is one shingle. Defined results: null, empty and wordless
texts have no shingles: each is a class of its own without links. A null id takes
part, but is no class id while another id of the class is known.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import fresh_name, gram_hashes, hash_words, materialize, mix64, serve
from activity_engine.llm.components import components

SHINGLE = 5
#: Similarity that links, as a fraction, so that it is compared exactly.
THRESHOLD = (4, 5)
RECALL = 0.9999
MAX_HASHES = 128
#: Classes in a block of a large group.
BLOCK = 256
_COLUMNS = 4096


def choose_bands(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band, then the fewest bands, that reach ``recall``."""
    for rows in range(max_hashes, 0, -1):
        miss = 1 - threshold ** rows
        for bands in range(1, max_hashes // rows + 1):
            if 1 - miss ** bands >= recall:
                return bands, rows
    raise ValueError("no banding reaches the recall")


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    own = hash_words((text or b"").lower().split())
    return np.unique(gram_hashes(own, min(n, len(own)))) if len(own) else own


def _band_hashes(grams: np.ndarray, factors: np.ndarray, bands: int) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), _COLUMNS):
        products = factors[:, None] * grams[None, at:at + _COLUMNS]
        np.minimum(least, products.min(axis=1), out=least)
    out = np.arange(bands, dtype=np.uint64)
    for column in mix64(least).reshape(bands, -1).T:
        out = mix64(out * np.uint64(31) + column)
    return out


def _sign(n: int, bands: int, rows: int):
    factors = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches):
        serve("jaccard_join")
        for batch in batches:
            known: dict = {}
            sets, sizes, signed = [], [], []
            for text in batch.column("_text").cast(pa.binary()).to_pylist():
                if text not in known:
                    grams = shingles(text, n)
                    known[text] = (xxhash.xxh3_64_intdigest(grams.tobytes()), len(grams),
                                   _band_hashes(grams, factors, bands) if len(grams) else np.empty(0, np.uint64))
                own = known[text]
                sets.append(own[0])
                sizes.append(own[1])
                signed.append(own[2])
            ends = np.concatenate([[0], np.cumsum([len(s) for s in signed])]).astype(np.int32)
            flat = np.concatenate([*signed, np.empty(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("t"), pa.array(np.array(sets, np.uint64).view(np.int64)),
                 pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                ["doc_id", "t", "k", "n", "bands"])

    return run


def _read_sets(n: int):
    def run(batches):
        for batch in batches:
            rows = [shingles(t, n).view(np.int64) for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)))
            names = ["k", "copies", "label", "blocks", "block"]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), grams], [*names, "grams"])

    return run


def linked(sets: list[np.ndarray], threshold: tuple[int, int]) -> np.ndarray:
    """Matrix of which sets reach the threshold with each other (not with themselves)."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)  # exact: counts stay below 2**24
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        part = np.zeros((len(sets), min(_COLUMNS, width - at)), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    out = common * threshold[1] >= union * threshold[0]
    np.fill_diagonal(out, False)
    return out


def _least_linked(links: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Least key of each set's component."""
    least = keys.copy()
    while True:
        near = np.where(links, least[None, :], least[:, None]).min(axis=1)
        near = np.minimum(near, least)
        if (near == least).all():
            return least
        least = near


def _verify(threshold: tuple[int, int]):
    """Rows sorted by pair of blocks -> each class's links there and the least class it reaches."""

    def solve(rows):
        keys = np.array([r["k"] for r in rows], np.int64)
        links = linked([np.array(r["grams"], np.int64) for r in rows], threshold)
        side = np.array([r["block"] for r in rows])
        if rows[0]["lo"] != rows[0]["hi"]:  # pairs inside a block are counted with that block alone
            links &= side[:, None] != side[None, :]
        copies = np.array([r["copies"] for r in rows], np.int64)
        return keys, links @ copies, _least_linked(links, keys), np.array([r["blocks"] for r in rows])

    def run(batches):
        group, last, out = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["label"], row["lo"], row["hi"])
                if key != last and group:
                    out.append(solve(group))
                    group = []
                last = key
                group.append(row)
            if out:
                yield pack(out)
                out = []
        if group:
            yield pack([solve(group)])

    def pack(parts):
        columns = [np.concatenate(c) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["k", "links", "least", "blocks"])

    return run


def jaccard_groups(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", n: int = SHINGLE,
                   threshold: tuple[int, int] = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, t (key of its text), k (its copy class), n (shingles),

    class_id (least id of all documents it is linked to, directly or not), copy_id (least id
    with the same shingles), n_links (other documents that reach the threshold), label.
    """
    bands, rows = choose_bands(threshold[0] / threshold[1], recall)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("t"), F.col(text_col).alias("_text"))
    signed = materialize(texts.mapInArrow(
        _sign(n, bands, rows), "doc_id long, t long, k long, n long, bands array<long>"), "signed")
    classes = materialize(signed.filter("n > 0").groupBy("k").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("copy_id"), F.min("t").alias("t"),
        F.first("bands").alias("bands")), "classes")
    banded = classes.select("k", F.posexplode("bands").alias("band", "hash"))
    leads = banded.groupBy("band", "hash").agg(F.min("k").alias("b"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    stars = banded.join(leads, ["band", "hash"]).select(F.col("k").alias("a"), "b")
    near = components(stars)
    labels = near.union(near.select(F.col("label").alias("node"), "label").distinct())
    sizes = labels.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    members = (labels.join(sizes, "label").join(classes.select(F.col("k").alias("node"), "copies", "t"), "node")
               .select(F.col("node").alias("k"), "copies", "label", "blocks",
                       F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "t"))
    sets = texts.dropDuplicates(["t"]).join(members, "t").mapInArrow(
        _read_sets(n), "k long, copies long, label long, blocks long, block long, grams array<long>")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    pairs = (sets.select("*", other)
             .select("k", "copies", "label", "blocks", "block", "grams",
                     F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")))
    checked = materialize(
        pairs.repartition("label", "lo", "hi").sortWithinPartitions("label", "lo", "hi")
        .mapInArrow(_verify(threshold), "k long, links long, least long, blocks long"), "checked")
    links = checked.groupBy("k").agg(F.sum("links").alias("links"), F.min("least").alias("least"))
    joined = components(checked.filter("blocks > 1").select(F.col("k").alias("a"), F.col("least").alias("b")))
    grouped = (classes.select("k", "copies", "copy_id").join(links, "k", "left")
               .join(joined.withColumnRenamed("node", "k").withColumnRenamed("label", "far"), "k", "left")
               .select("k", "copies", "copy_id", F.coalesce("links", F.lit(0)).alias("links"),
                       F.coalesce("far", "least", "k").alias("label")))
    grouped = materialize(grouped, "grouped")
    heads = grouped.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    final = grouped.join(heads, "label")
    return (signed.drop("bands").join(final, "k", "left")
            .select("doc_id", "t", "k", "n",
                    F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    F.when(F.col("n") > 0, F.col("copy_id")).otherwise(F.col("doc_id")).alias("copy_id"),
                    F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
                    F.when(F.col("n") > 0, F.col("label")).alias("label")))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each class: the least id (of equal ids, one row); wordless rows stay.

    All columns of ``docs`` are kept, whatever their names.
    """
    head = fresh_name(docs.columns, "_head")
    groups = materialize(jaccard_groups(docs, text_col, id_col, **options), "groups")
    heads = (groups.filter("n > 0").groupBy("label")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("head"))
             .select(F.struct("label", "head.doc_id", "head.t").alias(head)))
    same_text = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(head)["t"]
    kept = (docs.join(heads, same_text & F.col(id_col).cast("long").eqNullSafe(F.col(head)["doc_id"]))
            .dropDuplicates([head]).drop(head))
    wordless = docs.filter(~F.coalesce(F.col(text_col), F.lit("")).rlike("[^\\x20\\x09-\\x0D]"))
    return kept.union(wordless)


def join_digest(docs: DataFrame) -> DataFrame:
    """The columns of query ``op7_jaccard_join``."""
    return jaccard_groups(docs).select("doc_id", "class_id", "copy_id", "n_links")
