"""Benchmark decontamination by winnowing (operator 9).

Words are hashed; of the k-gram hashes in every window of ``span - k + 1`` k-grams
the smallest (rightmost of equals) is a fingerprint. Two texts that share ``span``
consecutive words therefore share a fingerprint at the same place of that run.
Test items shorter than ``span`` words have one fingerprint of their own length,
which documents answer at every position.

Documents first look their fingerprints up in a bit table of fixed size made from
the benchmark's fingerprints; those that pass carry the word hashes around them to
a shuffle join on the fingerprint, where each hit is extended word by word to the
whole windows it lies in. No side of the join is broadcast by hint, and equal
passages of a document meet each item once per fingerprint.

Words are compared by 64-bit hashes. Defined results: null and empty texts have
no words and are clean; repeated rows each get their result; a benchmark without
rows leaves every document clean; an item without an id taints documents, but is
not listed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import fresh_name, gram_hashes, hash_words, materialize, serve

SPAN = 10
GRAM = 5
#: Size of the bit table (bits); a full table only lets more rows through.
FILTER_BITS = 1 << 20

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80))
_TABLE = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_BLANKS = bytes(b for b in _SEPARATORS if not 0x41 <= b <= 0x5A)
_TABLE = bytes(0x20 if b in _BLANKS else _TABLE[b] for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    """Words of ASCII digits, letters (A-Z lowered) and every character beyond ASCII."""
    return text.translate(_TABLE).split() if text else []


def fingerprints(hashes: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Positions of the k-grams that are the rightmost minimum of some window."""
    width = span - gram + 1
    count = len(hashes)
    if count < width:
        return np.empty(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    least = width - 1 - windows.argmin(axis=1)
    return np.unique(least + np.arange(len(windows)))


def _contexts(hashes: np.ndarray, at: np.ndarray, before: int, after: int) -> np.ndarray:
    """Word hashes from ``before`` words ahead of each position to ``after`` past it.

    Zero stands for what lies outside the text.
    """
    padded = np.concatenate([np.zeros(before, np.uint64), hashes, np.zeros(after, np.uint64)])
    return padded[at[:, None] + np.arange(before + after)]


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    values = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind.to_pandas_dtype())))


def item_fingerprints(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(item, length, fp, at, words): fingerprints of test items with the words around them."""
    before = span - gram

    def scan(batches):
        serve("winnowing")
        for batch in batches:
            out = {"item": [], "length": [], "fp": [], "at": [], "words": []}
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            for item, text in zip(batch.column("item").to_pylist(), texts):
                own = hash_words(words(text))
                if not len(own):
                    continue
                if len(own) < span:
                    at, grams, length = np.zeros(1, np.int64), gram_hashes(own, len(own)), len(own)
                else:
                    grams, length = gram_hashes(own, gram), span
                    at = fingerprints(grams, span, gram)
                around = _contexts(own, at, before, span)
                for i, p in enumerate(at):
                    out["item"].append(item)
                    out["length"].append(length)
                    out["fp"].append(int(grams[p].view(np.int64)))
                    out["at"].append(int(p))
                    out["words"].append(around[i].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["item"], pa.string()), pa.array(out["length"], pa.int32()),
                 pa.array(out["fp"], pa.int64()), pa.array(out["at"], pa.int32()),
                 _lists(out["words"], pa.int64())], ["item", "length", "fp", "at", "words"])

    return items.mapInArrow(scan, "item string, length int, fp long, at int, words array<long>")


def _document_hits(docs: DataFrame, bits: bytes, lengths: list[int], span: int, gram: int) -> DataFrame:
    """Per row: its key, word count and the fingerprints that pass the bit table."""
    before = span - gram
    mask = np.uint64(FILTER_BITS - 1)

    def scan(batches):
        serve("winnowing")
        table = np.unpackbits(np.frombuffer(bits, np.uint8))
        for batch in batches:
            counts, length, fp, at, around = [], [], [], [], []
            for text in batch.column("_text").cast(pa.binary()).to_pylist():
                own = hash_words(words(text))
                counts.append(len(own))
                row_length, row_fp, row_at = [], [], []
                for n in lengths:
                    grams = gram_hashes(own, gram if n == span else n)
                    places = fingerprints(grams, span, gram) if n == span else np.arange(len(grams))
                    places = places[table[(grams[places] & mask).astype(np.int64)] > 0]
                    row_length.append(np.full(len(places), n))
                    row_fp.append(grams[places].view(np.int64))
                    row_at.append(places)
                places = np.concatenate([*row_at, np.empty(0, np.int64)]).astype(np.int64)
                length.append(np.concatenate([*row_length, np.empty(0, np.int64)]))
                fp.append(np.concatenate([*row_fp, np.empty(0, np.int64)]))
                at.append(places)
                around.extend(_contexts(own, places, before, span).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int32)
            flat = lambda rows: np.concatenate([*rows, np.empty(0, np.int64)])
            hits = pa.StructArray.from_arrays(
                [pa.array(flat(length).astype(np.int32)), pa.array(flat(fp).astype(np.int64)),
                 pa.array(flat(at).astype(np.int32)), _lists(around, pa.int64())],
                ["length", "fp", "at", "words"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), hits)],
                ["row", "doc_id", "n_words", "hits"])

    return docs.mapInArrow(
        scan, "row long, doc_id long, n_words long,"
              " hits array<struct<length: int, fp: long, at: int, words: array<long>>>")


def _extend(span: int, gram: int):
    """Joined fingerprints -> starts of the whole windows that both texts share."""
    before = span - gram

    def run(batches):
        for batch in batches:
            length = np.asarray(batch.column("length"))
            shape = (len(length), before + span)
            left = np.asarray(batch.column("words").flatten()).reshape(shape)
            right = np.asarray(batch.column("item_words").flatten()).reshape(shape)
            same = (left == right) & (left != 0)
            runs = np.concatenate([np.zeros((len(length), 1), np.int64), same.cumsum(axis=1)], axis=1)
            whole = runs[:, span:] - runs[:, :-span] == span  # a window from `before` words ahead on
            short = length < span
            fits = np.take_along_axis(runs, np.minimum(before + length, shape[1])[:, None], 1)[:, 0] - runs[:, before]
            whole[short] = False
            whole[short, before] = fits[short] == length[short]
            row, step = np.nonzero(whole[:, :before + 1])
            at = np.asarray(batch.column("at"))[row] + step - before
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(row)), pa.array(at.astype(np.int64)),
                 pa.array(length[row].astype(np.int32)), batch.column("item").take(pa.array(row))],
                ["row", "at", "length", "item"])

    return run


def find_contamination(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                       item_text: str = "text", item_id: str = "item_id",
                       span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: row, doc_id, n_words, spans (start, length), items (sorted texts of ids)."""
    tests = materialize(item_fingerprints(
        items.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("_text")),
        span, gram), "items")
    slots = [r[0] for r in tests.select(F.col("fp").bitwiseAND(F.lit(FILTER_BITS - 1))).distinct().collect()]
    lengths = sorted(r[0] for r in tests.select("length").distinct().collect())
    table = np.zeros(FILTER_BITS, np.uint8)
    table[slots] = 1
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).alias("_text"))
    found = materialize(_document_hits(source, np.packbits(table).tobytes(), lengths, span, gram), "hits")
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    pairs = hits.join(tests.select("fp", "length", "item", F.col("words").alias("item_words")), ["fp", "length"])
    windows = pairs.select("row", "at", "length", "words", "item", "item_words").mapInArrow(
        _extend(span, gram), "row long, at long, length int, item string")
    per_row = windows.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("at", "length"))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"))
    return (found.select("row", "doc_id", "n_words").join(per_row, "row", "left")
            .select("row", "doc_id", "n_words",
                    F.coalesce("spans", F.array().cast("array<struct<at: bigint, length: int>>")).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def covered_words(spans) -> F.Column:
    """Words inside the union of sorted (at, length) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(state, span):
        end = span["at"] + span["length"]
        fresh = F.greatest(F.lit(0).cast("long"), end - F.greatest(state["end"], span["at"]))
        return F.struct(F.greatest(state["end"], end).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(spans, zero, add)["n"]


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text shares no window with an item, with all columns, whatever their names."""
    key, hit = fresh_name(docs.columns, "_key"), fresh_name(docs.columns, "_hit")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    found = find_contamination(keyed, items, text_col, key)
    hits = found.filter(F.size("spans") > 0).select(F.col("doc_id").alias(hit)).distinct()
    return keyed.join(hits, F.col(key) == F.col(hit), "left_anti").drop(key)


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of query ``op9_winnowing``."""
    found = find_contamination(docs, items)
    n_hit = covered_words(F.col("spans"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
