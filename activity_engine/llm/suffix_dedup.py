"""Suffix-array dedup: remove bytes covered by long strings that occur twice (operator 6).

A byte goes if some ``length``-byte string that covers it also starts anywhere else.
Work is cut so that no task needs the corpus:

1. *Ownership.* Every window of ``length`` bytes is owned by the rightmost least
   hash among the ``GRAM``-byte strings it contains. Equal windows have equal
   owners at the same place, so they meet under that hash. Consecutive windows
   with one owner form a *stretch*; a stretch and its hash make one narrow row.
2. *Counting.* Hashes seen once are dropped. Identical stretches of a hash are counted
   together (map-side) and repeated as they stand. Where a hash has others too, those
   that are not repeated as they stand, and one of each that is, go on.
3. *Two-stage sorting.* The bytes of those stretches are fetched and bucketed by
   hash. In a bucket the suffixes that are smaller than their successors are
   sorted directly; the others are induced by scanning the buckets of the first
   character in order. Neighbours in the suffix array whose common prefix reaches
   ``length`` mark their windows as repeated.
4. A hash with more than ``BUCKET_STRETCHES`` different stretches does not fit one
   task; its windows are spread by their own 128-bit hash and counted exactly.

With ``words``, what is covered by a run of so many words that two or more documents
hold goes too, however few bytes it has. Runs are owned by the least hash of the
``GRAM_WORDS`` words they contain, as windows are, and their stretches take steps 1 and 2
in the same jobs (their hashes are odd, those of bytes even); the runs of what goes on
are told apart by a 64-bit hash of their words. White space between words makes no
difference; a run that one document alone repeats stays.

Texts are told apart by a 64-bit hash, windows of one bucket by their bytes.
Defined results: null is an empty text; texts shorter than ``length`` keep all
bytes; repeated rows are copies of each other like any others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import fresh_name, materialize, mix64, serve

LENGTH = 400
GRAM = 256
#: Words of the shortest passage that counts as shared by documents: over 50.
PASSAGE_WORDS = 51
#: Words (a power of two) by which a run of words is owned.
GRAM_WORDS = 32
#: Window starts handled at once while scanning a text.
SEGMENT = 1 << 16
#: Bytes of stretches sorted at once (whole hashes only).
BUCKET_BYTES = 1 << 20
#: Different stretches of one hash that a task sorts.
BUCKET_STRETCHES = 1 << 16

_MIX = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
_ONE = np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.full(count - 1, base, np.uint64)]).cumprod(dtype=np.uint64)


#: Bytes hashed at once, by a polynomial of base _MIX | 3.
_AT_ONCE = 2 * SEGMENT + 4096
_POWER, _INVERSE = _powers(_MIX | 3, _AT_ONCE), _powers(pow(_MIX | 3, -1, 2**64), _AT_ONCE)
#: A number for each byte; white space between words has none.
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MIX)) | np.uint64(1)
_LETTER = _BYTE.copy()
_LETTER[[9, 10, 11, 12, 13, 32]] = 0


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at each position, by differences of a polynomial's sums."""
    out = []
    step = max(1, _AT_ONCE - gram)
    for at in range(0, len(data) - gram + 1, step):
        part = data[at:at + step + gram - 1]
        if len(part) > _AT_ONCE:
            raise ValueError(f"strings of {gram} bytes are too long to be hashed")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[part] * _POWER[:len(part)], dtype=np.uint64)])
        out.append(mix64((sums[gram:] - sums[:-gram]) * _INVERSE[:len(part) - gram + 1]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values if size == width else np.minimum(values[:size - width], values[width - size:])


def stretches(hashes: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Owned stretches of a buffer of texts that end at ``ends``, by hashes of ``gram`` bytes or words.

    Arrays of hash, first and last window start.
    """
    none = np.empty(0, np.int64)
    if len(hashes) < length - gram + 1:
        return hashes[:0], none, none
    place = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_min((hashes & ~_LOW) | (_LOW - place), length - gram + 1)
    owner = (_LOW - (least & _LOW)).astype(np.int64)
    inside = np.ones(len(owner), bool)
    for end in ends.tolist():  # what begins too late to end in its text
        inside[max(0, end - length + 1):end] = False
    start = np.flatnonzero(inside)
    owner = owner[start]
    if not len(start):
        return hashes[:0], none, none
    cut = np.flatnonzero((np.diff(owner) != 0) | (np.diff(start) != 1)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(start) - 1]])
    return hashes[owner[first]], start[first], start[last]


def _segments(texts, length: int):
    """Texts cut into runs of SEGMENT starts, packed into buffers: (row, offset, bytes) lists."""
    pack, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, SEGMENT):
            part = text[at:at + SEGMENT + length - 1]
            pack.append((row, at, part))
            size += len(part)
            if size >= SEGMENT:
                yield pack
                pack, size = [], 0
    if pack:
        yield pack


def _byte_stretches(texts, length: int, gram: int, contents: bool):
    """Rows of text, hash, content and byte span of the stretches of ``length``-byte windows."""
    for pack in _segments(texts, length):
        joined = b"".join([p[2] for p in pack])
        ends = np.cumsum([len(p[2]) for p in pack])
        hashes, first, last = stretches(_gram_hashes(np.frombuffer(joined, np.uint8), gram), ends, length, gram)
        hashes = (hashes & ~_ONE).view(np.int64)
        if not contents:
            yield [hashes]
            continue
        begins = np.concatenate([[0], ends[:-1]])
        which = np.searchsorted(ends, first, side="right")
        offset = np.array([p[1] for p in pack], np.int64)[which] - begins[which]
        content = [xxhash.xxh3_64_intdigest(joined[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())]
        yield [hashes, np.array(content, np.uint64).view(np.int64), np.array([p[0] for p in pack], np.int64)[which],
               first + offset, last + length + offset]


def _word_stretches(texts, words: int, contents: bool):
    """The same of runs of ``words`` words; a stretch's content is that of its words."""

    def solve(pack):
        joined = b" ".join([p[1] for p in pack])
        text_ends = np.cumsum([len(p[1]) + 1 for p in pack])
        begins, ends = _word_bounds(joined)
        grams = _word_gram_hashes(_word_hashes(joined, begins, ends))
        hashes, first, last = stretches(grams, np.searchsorted(begins, text_ends), words, GRAM_WORDS)
        hashes = (hashes | _ONE).view(np.int64)
        if not contents:
            return [hashes]
        content = _run_hashes(grams, first, words)
        content = mix64(content * np.uint64(_MIX) + grams[last + words - GRAM_WORDS])
        content = mix64(content * np.uint64(_MIX) + (last - first).astype(np.uint64))
        which = np.searchsorted(text_ends, begins[first], side="right")
        offset = np.concatenate([[0], text_ends[:-1]])[which]
        return [hashes, content.view(np.int64), np.array([p[0] for p in pack], np.int64)[which],
                begins[first] - offset, ends[last + words - 1] - offset]

    pack, size = [], 0
    for row, text in enumerate(texts):
        if len(text) < 2 * words - 1:
            continue
        pack.append((row, text))
        size += len(text)
        if size >= SEGMENT:
            yield solve(pack)
            pack, size = [], 0
    if pack:
        yield solve(pack)


def _scan(length: int, gram: int, words: int | None, contents: bool = True):
    """Texts -> their stretches: hash, content, text and byte span; without ``contents`` the hash alone."""
    names = ["h", "c", "t", "lo", "hi"] if contents else ["h"]

    def run(batches):
        serve("suffix_dedup")
        for batch in batches:
            texts = [t or b"" for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            found = list(_byte_stretches(texts, length, gram, contents))
            if words:
                found += _word_stretches(texts, words, contents)
            columns = [np.concatenate([*x]) for x in zip(*found)] or [np.empty(0, np.int64)] * len(names)
            if contents:
                columns[2] = np.asarray(batch.column("t"))[columns[2]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names)

    return run


def _fetch(batches):
    """Rows of a text and its wanted stretches -> the bytes of the stretches."""
    for batch in batches:
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        lists = batch.column("wanted")
        row = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
        wanted = pa.RecordBatch.from_struct_array(lists.flatten())
        parts = [texts[r][lo:hi] for r, lo, hi in zip(row.tolist(), *(wanted.column(n).to_pylist() for n in ("lo", "hi")))]
        yield pa.RecordBatch.from_arrays(
            [wanted.column("h"), batch.column("t").take(pa.array(row)), wanted.column("lo"), wanted.column("whole"),
             wanted.column("hot"), pa.array(parts, pa.binary())], ["h", "t", "lo", "whole", "hot", "stretch"])


def _direct_sort(data: bytes, words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """``places`` in the order of the first ``length`` bytes that stand there."""
    keys = words[places]
    order = np.argsort(keys, kind="stable")
    places, keys = places[order], keys[order]
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(places)]])
    ties = ends - begins > 1
    for a, b in zip(begins[ties].tolist(), ends[ties].tolist()):
        run = places[a:b].tolist()
        run.sort(key=lambda p: data[p + 8:p + length])
        places[a:b] = run
    return places


def suffix_order(data: bytes, wanted: np.ndarray, length: int) -> np.ndarray:
    """Wanted positions of ``data`` in suffix order (to ``length`` bytes), by two-stage sorting.

    ``data`` must go on for ``length`` bytes after the last wanted position and end
    in a byte that is larger than its predecessor.
    """
    chars = np.frombuffer(data, np.uint8)
    step = np.diff(chars.astype(np.int16))
    index = np.where(step != 0, np.arange(len(step)), len(step) - 1)
    index = np.minimum.accumulate(index[::-1])[::-1]
    rising = step[index] > 0  # the suffix is smaller than its successor
    marked = np.zeros(len(chars), bool)
    marked[wanted] = True
    edge = np.flatnonzero(marked[:-1] & ~marked[1:])
    while len(edge):  # induction needs what follows, to the next rising place
        edge = edge[~rising[edge]] + 1
        edge = edge[~marked[edge]]
        marked[edge] = True
    places = np.flatnonzero(marked)
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    direct = _direct_sort(data, words, places[rising[places]], length)
    falling = marked[:-1] & ~rising
    bounds = np.searchsorted(chars[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []
    for char in range(256):
        induced = []
        found = np.concatenate(waiting[char]) if waiting[char] else direct[:0]
        while len(found):
            induced.append(found)
            before = found[found > 0] - 1
            found = before[falling[before] & (chars[before] == char)]
        bucket = np.concatenate([*induced, direct[bounds[char]:bounds[char + 1]]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[falling[before] & (chars[before] > char)]
        if len(before):
            own = chars[before]
            sort = np.argsort(own, kind="stable")
            before, own = before[sort], own[sort]
            for part in np.split(before, np.flatnonzero(np.diff(own)) + 1):
                waiting[chars[part[0]]].append(part)
    order = np.concatenate(order)
    keep = np.zeros(len(chars), bool)
    keep[wanted] = True
    return order[keep[order]]


def common_prefix_reaches(data: bytes, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each place and the next of ``order`` share ``length`` bytes."""
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    alive = np.arange(len(order) - 1)
    for at in [*range(0, length - 7, 8), length - 8]:
        alive = alive[words[order[alive] + at] == words[order[alive + 1] + at]]
    out = np.zeros(max(0, len(order) - 1), bool)
    out[alive] = True
    return out


def _repeated(parts: list[bytes], length: int) -> np.ndarray:
    """For each window start of each stretch, in order, whether its window occurs twice."""
    sizes = np.array([len(p) for p in parts])
    counts = sizes - length + 1
    begins = np.cumsum(sizes) - sizes
    ids = np.cumsum(counts) - counts
    wanted = np.repeat(begins - ids, counts) + np.arange(counts.sum())
    data = b"".join(parts) + b"\0" * length + b"\xff"
    order = suffix_order(data, wanted, length)
    equal = common_prefix_reaches(data, order, length)
    twice = np.zeros(len(order), bool)
    twice[:-1] |= equal
    twice[1:] |= equal
    out = np.zeros(len(data), bool)
    out[order[twice]] = True
    return out[wanted]


def _sort_buckets(length: int):
    """Stretches sorted by hash -> byte spans of their repeated windows."""

    def solve(rows):
        flags = _repeated([r[3] for r in rows], length)
        texts, lo, hi = [], [], []
        at = 0
        for key, first, whole, part in rows:
            count = len(part) - length + 1
            own = flags[at:at + count]
            at += count
            if whole or not own.any():
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                texts.append(key)
                lo.append(first + a)
                hi.append(first + b - 1 + length)
        return pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["t", "lo", "hi"])

    def run(batches):
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("h", "t", "lo", "whole", "stretch"))):
                if size >= BUCKET_BYTES and row[0] != last:
                    yield solve(rows)
                    rows, size = [], 0
                last = row[0]
                rows.append(row[1:])
                size += len(row[4])
        if rows:
            yield solve(rows)

    return run


def _spread(length: int):
    """Stretches -> one row a window: its 128-bit hash, text, start and whether its stretch goes anyway."""

    def run(batches):
        for batch in batches:
            out = {"w1": [], "w2": [], "t": [], "lo": [], "whole": []}
            for key, first, whole, part in zip(*(batch.column(n).to_pylist() for n in ("t", "lo", "whole", "stretch"))):
                for i in range(len(part) - length + 1):
                    high, low = divmod(xxhash.xxh3_128_intdigest(part[i:i + length]), 1 << 64)
                    out["w1"].append(high - (1 << 63))
                    out["w2"].append(low - (1 << 63))
                    out["t"].append(key)
                    out["lo"].append(first + i)
                    out["whole"].append(whole)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, pa.bool_() if n == "whole" else pa.int64()) for n, v in out.items()], list(out))

    return run


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   bucket_stretches: int = BUCKET_STRETCHES, words: int | None = None) -> DataFrame:
    """(t, spans, passages): byte spans of each text that has any, by the text's key: those of
    repeated ``length``-byte strings, and those of runs of ``words`` words in several documents.

    A run is in several documents if it is in two texts or if its text has copies; one
    that a single document repeats is not.
    """
    if words and not GRAM_WORDS <= words <= 2 * GRAM_WORDS:
        raise ValueError(f"runs have {GRAM_WORDS} to {2 * GRAM_WORDS} words, not {words}")
    texts = docs.select(text_key(F.col(text_col)).alias("t"), F.col(text_col).alias("_text"))
    long_texts = texts.filter(F.octet_length("_text") >= min(length, 2 * words - 1 if words else length))
    passage = F.col("h") % 2 != 0
    # Written first, so that both sides of the joins are plain shuffles, whose hot keys Spark can split.
    hashes = materialize(long_texts.mapInArrow(_scan(length, gram, words, contents=False), "h long")
                         .groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "hashes")
    owned = long_texts.mapInArrow(_scan(length, gram, words), "h long, c long, t long, lo long, hi long")
    seen = materialize(owned.join(hashes, "h").select(*owned.columns), "stretches")
    places = seen.groupBy(*owned.columns).agg(F.count(F.lit(1)).alias("copies"))
    kinds = places.groupBy("h", "c").agg(
        F.sum("copies").alias("n"), F.max("copies").alias("copies"), F.count(F.lit(1)).alias("places"),
        F.min(F.struct("t", "lo", "hi")).alias("one"), F.max("t").alias("other"))
    shared = F.when(passage, (F.col("one.t") != F.col("other")) | (F.col("copies") > 1)).otherwise(F.col("n") > 1)
    kinds = materialize(kinds.select("h", "c", "places", "one", shared.alias("whole")), "kinds")
    # Of the runs that one text holds more than once, each place is wanted.
    dealt = materialize(seen.join(kinds.filter("whole or places > 1").select("h", "c", "whole"), ["h", "c"])
                        .select("h", "t", "lo", "hi", "whole"), "dealt")
    groups = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.every("whole").alias("done"))
    wanted = (kinds.filter("whole or places = 1").select("h", "one.*", "whole")
              .union(dealt.filter("not whole").distinct())
              .join(groups.filter("kinds > 1 and not done"), "h")
              .withColumn("hot", F.col("kinds") > bucket_stretches))
    per_text = wanted.groupBy("t").agg(F.collect_list(F.struct("h", "lo", "hi", "whole", "hot")).alias("wanted"))
    fetched = long_texts.dropDuplicates(["t"]).join(per_text, "t").select("t", "_text", "wanted").mapInArrow(
        _fetch, "h long, t long, lo long, whole boolean, hot boolean, stretch binary")
    fetched = materialize(fetched, "bytes")
    of_bytes = fetched.filter(~passage)
    spans = "t long, lo long, hi long"
    sorted_spans = (of_bytes.filter("not hot").select("h", "t", "lo", "whole", "stretch")
                    .repartition("h").sortWithinPartitions("h").mapInArrow(_sort_buckets(length), spans))
    windows = of_bytes.filter("hot").select("t", "lo", "whole", "stretch").mapInArrow(
        _spread(length), "w1 long, w2 long, t long, lo long, whole boolean")
    twice = (windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2"))
    spread_spans = (windows.filter("not whole").join(twice, ["w1", "w2"])
                    .select("t", "lo", (F.col("lo") + length).alias("hi")))
    ends = dealt.filter("whole").withColumn("passage", passage).select("t", "lo", "hi", "passage")
    every = ends.union(sorted_spans.union(spread_spans).withColumn("passage", F.lit(False)))
    if words:
        runs = fetched.filter(passage).select("t", "lo", "whole", "stretch").mapInArrow(
            _runs(words), "run long, t long, lo long, hi long, whole boolean")
        several = (runs.groupBy("run").agg(F.min("t").alias("one"), F.max("t").alias("other"), F.max("whole").alias("whole"))
                   .filter("one != other or whole").select("run"))
        every = every.union(runs.filter("not whole").join(several, "run").select("t", "lo", "hi")
                            .withColumn("passage", F.lit(True)))
    span = F.struct("lo", "hi")
    return every.groupBy("t").agg(F.collect_set(F.when(~F.col("passage"), span)).alias("spans"),
                                  F.collect_set(F.when(F.col("passage"), span)).alias("passages"))


def _word_bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of ``bytes.split`` begin and end."""
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = _LETTER[np.frombuffer(text, np.uint8)] != 0
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _word_hashes(text: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words between ``begins`` and ``ends``."""
    chars = np.frombuffer(text, np.uint8)
    out = np.empty(len(begins), np.uint64)
    at = 0
    while at < len(begins):
        base = begins[at]
        stop = int(np.searchsorted(ends, base + _AT_ONCE, side="right"))
        if stop <= at:  # a word longer than what is handled at once
            out[at] = xxhash.xxh3_64_intdigest(text[base:ends[at]])
            at += 1
            continue
        terms = _LETTER[chars[base:ends[stop - 1]]]
        terms *= _POWER[:len(terms)]
        first = begins[at:stop] - base
        out[at:stop] = np.add.reduceat(terms, first) * _INVERSE[first]
        at = stop
    return mix64(out + (ends - begins).astype(np.uint64) * np.uint64(_MIX))


def _word_gram_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the GRAM_WORDS words at each word, from those of the words."""
    size = 1
    while size < GRAM_WORDS:
        hashes = mix64(hashes[:-size] * np.uint64(_MIX) + hashes[size:])
        size *= 2
    return hashes


def _run_hashes(hashes: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """Hashes of the ``words`` words at some words of a text, from those of GRAM_WORDS words."""
    return mix64(hashes[at] * np.uint64(_MIX) + hashes[at + words - GRAM_WORDS])


def _runs(words: int):
    """Stretches of runs -> one row a run: its hash, text, byte span and whether its stretch goes anyway."""

    def run(batches):
        for batch in batches:
            parts = batch.column("stretch").to_pylist()
            if not parts:
                continue
            joined = b" ".join(parts)
            part_ends = np.cumsum([len(p) + 1 for p in parts])
            begins, ends = _word_bounds(joined)
            grams = _word_gram_hashes(_word_hashes(joined, begins, ends))
            counts = np.diff(np.searchsorted(begins, part_ends), prepend=0)
            which = np.repeat(np.arange(len(parts)), counts - words + 1)
            at = np.arange(len(which)) + which * (words - 1)
            offset = np.asarray(batch.column("lo"))[which] - np.concatenate([[0], part_ends[:-1]])[which]
            own = pa.array(which)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_run_hashes(grams, at, words).view(np.int64)), batch.column("t").take(own),
                 pa.array(begins[at] + offset), pa.array(ends[at + words - 1] + offset), batch.column("whole").take(own)],
                ["run", "t", "lo", "hi", "whole"])

    return run


def removal(text: Column, spans: Column, kept: bool = True) -> Column:
    """Struct of the figures of removing ``spans`` from ``text``, and with ``kept`` the text that is left.

    A character that loses only some of its bytes is dropped from ``kept_text``.
    """
    kind = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * kept
    fields = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
              *[("kept_text", pa.string())] * kept]

    @F.arrow_udf(kind)
    def remove(texts: pa.Array, lists: pa.Array) -> pa.Array:
        rows = []
        for text, own in zip(texts.cast(pa.binary()).to_pylist(), lists.to_pylist()):
            text = text or b""
            parts, runs, gone, at = [], 0, 0, 0
            for lo, hi in sorted((s["lo"], s["hi"]) for s in own or ()):
                if not runs or lo > at:
                    parts.append(text[at:lo])
                    runs += 1
                    at = lo
                gone += max(0, hi - at)
                at = max(at, hi)
            parts.append(text[at:])
            left = b"".join(parts)
            rows.append({"n_bytes": len(text), "n_removed": gone, "n_spans": runs,
                         "kept_sha256": hashlib.sha256(left).hexdigest()})
            if kept:
                rows[-1]["kept_text"] = left.decode("utf-8", "ignore")
        return pa.array(rows, pa.struct(fields))

    return remove(text, spans)


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   bucket_stretches: int = BUCKET_STRETCHES, words: int | None = None,
                   out: str = "_removal") -> DataFrame:
    """``docs`` with a struct column ``out`` (see ``removal``), in place of one of that name.

    With ``words`` the runs of so many words that several documents hold go as well.
    """
    found = fresh_name([*docs.columns, out], "_found")
    spans = F.concat(F.col(found)["spans"], F.col(found)["passages"])
    joined = _with_spans(docs, found, text_col, length, gram, bucket_stretches, words)
    return joined.withColumn(out, removal(F.col(text_col), spans)).drop(found)


def _with_spans(docs: DataFrame, found: str, text_col: str, *options) -> DataFrame:
    spans = repeated_spans(docs, text_col, *options).select(F.struct("t", "spans", "passages").alias(found))
    return docs.join(spans, text_key(F.col(text_col)) == F.col(found)["t"], "left")


def covered(spans: Column) -> Column:
    """Bytes inside any of the spans; null or no spans: 0."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("bytes"))

    def add(done, span):
        more = F.greatest(F.lit(0).cast("long"), span["hi"] - F.greatest(done["at"], span["lo"]))
        return F.struct(F.greatest(done["at"], span["hi"]).alias("at"), (done["bytes"] + more).alias("bytes"))

    return F.coalesce(F.aggregate(F.array_sort(spans), start, add, lambda done: done["bytes"]), F.lit(0).cast("long"))


def dedup_digest(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                 bucket_stretches: int = BUCKET_STRETCHES, words: int = PASSAGE_WORDS) -> DataFrame:
    """The columns of query ``op6_suffix_dedup``.

    ``n_passage_bytes`` (long) is beside the figures of removal, not part of them: bytes in
    runs of ``words`` words that another document holds too, however few bytes they have.
    """
    joined = _with_spans(docs.select("doc_id", "text"), "_found", "text", length, gram, bucket_stretches, words)
    cut = joined.withColumn("_removal", removal(F.col("text"), F.col("_found.spans"), kept=False))
    return cut.select("doc_id", "_removal.n_bytes", "_removal.n_removed", "_removal.n_spans", "_removal.kept_sha256",
                      covered(F.col("_found.passages")).alias("n_passage_bytes"))
