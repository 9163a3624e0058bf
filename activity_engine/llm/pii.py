"""Personal data: fixed forms, and terms that give their owners away (operator 11).

Emails, IP addresses, card and phone numbers are found by their form; each distinct one
is a protected entity. What the corpus says about an entity is information-theoretic:
pick a word position at random; c is the event that it lies within ``WINDOW`` words of a
mention of the entity, t that the word there is t. From counts over the whole corpus

    disclosure(c; t) = PMI(c; t) / IC(c) = 1 - ln p(c | t) / ln p(c)

is the share of the entity's information that t gives away (1: t occurs nowhere else). A
term discloses if that reaches ``THRESHOLDS`` for some entity beside which it stands in
at least ``SUPPORT`` different surroundings (copies of one text count as one). Its
occurrences become spans of kind ``term`` wherever they stand, in texts without the entity
too. To sanitise, a base span is replaced by its kind, a term by its stem (``STEM``
characters and ``*``) if the stem, counted over all words that share it, discloses no entity, and
is removed otherwise.

Three passes over the texts: mentions with the words around them; corpus counts of the
words and stems that came up often enough; occurrences of the terms that disclose. Between passes
only words go out, in a table of bits sized by their number (at most 2^27 bits; a fuller
table lets more rows into the join, never fewer); counts, disclosure and the joins are
shuffles on words and entities, combined map-side.

A word is a run of letters and digits, lower-cased. Words inside a base span are no terms,
but count as word positions of the corpus.
Defined results: a null or empty text has no spans; repeated rows each get their result;
ties do not arise (all that reaches a threshold counts); an empty table gives no rows;
ids may be null or repeat. ``sanitise`` keeps all columns of its input, whatever they are
called, and only ``text_col`` changes. Very long texts are read whole, in linear time.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Cache, fresh_name, materialize

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words on either side of a mention that count as its surroundings.
WINDOW = 12
#: Least number of different surroundings of one entity that a term must stand in.
SUPPORT = 3
#: Share of an entity's information that a term may not reach.
THRESHOLD = 0.95
#: Characters of the stem that a term is generalised to.
STEM = 4
#: Bits of the largest table of words, bits a word and bits set for one.
MOST_BITS = 1 << 27
WORD_BITS = 24
WORD_SLOTS = 6

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that does not start an address at its first digit does not at a later one.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")
_DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(_DOUBLED[d] for d in values[1::2])) % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, from each @: the run of local characters before it, the domain after."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of emails, addresses, cards and phones, in order."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.groups()):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def entity(kind: int, mention: str) -> str:
    """One text for all spellings of an entity."""
    value = mention.lower() if kind == 0 else mention if kind == 1 else re.sub(r"[^0-9]", "", mention)
    return f"{KINDS[kind]}:{value}"


def stem(word: str) -> str:
    return word[:STEM] + "*"


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """(lower-cased word, start, end) of the words that no span touches, in order."""
    out, k, reach = [], 0, 0
    for m in _WORD.finditer(text):
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][2])
            k += 1
        if m.start() >= reach:
            out.append((m.group().lower(), m.start(), m.end()))
    return out


def surroundings(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int]]:
    """(entity, word or stem, surroundings, occurrences) of one text.

    A position beside several mentions of an entity counts once for it. Where mentions
    are close, their surroundings are one, told apart by a hash of its words.
    """
    words = words_outside(text, spans)
    starts = np.array([w[1] for w in words], np.int64)
    ranges: dict[str, list[list[int]]] = {}
    for start, kind, end in spans:
        at = int(np.searchsorted(starts, start))
        low, high = max(0, at - WINDOW), min(len(words), at + WINDOW)
        held = ranges.setdefault(entity(kind, text[start:end]), [])
        if held and low < held[-1][1]:
            held[-1][1] = max(high, held[-1][1])
        else:
            held.append([low, high])
    out = []
    for name, parts in ranges.items():
        for low, high in parts:
            near = [w[0] for w in words[low:high]]
            place = xxhash.xxh3_64_intdigest("\n".join(near).encode("utf-8", "surrogatepass")) - (1 << 63)
            counts = Counter(near)
            counts.update(stem(w) for w in near)
            out.extend((name, term, place, n) for term, n in counts.items())
    return out


# -- tables of words ----------------------------------------------------------------

def _slots(word: str, size: int) -> list[int]:
    digest = xxhash.xxh3_128_intdigest(word.encode("utf-8", "surrogatepass"))
    first, step = digest >> 64, digest & (1 << 64) - 1 | 1
    return [(first + k * step) % size for k in range(WORD_SLOTS)]


class WordTable:
    """Bloom filter of a set of words: what is not in the set is found with a chance under 1 in 1,000."""

    def __init__(self, words: DataFrame, column: str):
        count = words.count()
        self.size = size = min(MOST_BITS, 1 << max(16, (WORD_BITS * count).bit_length()))

        def slots(batches):
            bits = np.zeros(size // 8, np.uint8)
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    for s in _slots(word, size):
                        bits[s >> 3] |= 1 << (s & 7)
            # Only words of 64 bits that hold something leave the task.
            whole = bits.view(np.int64)
            at = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(whole[at])], ["at", "bits"])

        parts = (words.select(column).mapInArrow(slots, "at long, bits long")
                 .groupBy("at").agg(F.bit_or("bits").alias("bits")))
        whole = np.zeros(size // 64, np.int64)
        found = parts.toArrow()                       # at most MOST_BITS / 64 rows
        whole[np.asarray(found.column("at"))] = np.asarray(found.column("bits"))
        self.bits = words.sparkSession.sparkContext.broadcast(whole.tobytes())

    def reader(self):
        """A test of words, to be called in a task."""
        bits, size = self.bits.value, self.size

        def holds(word: str) -> bool:
            return all(bits[s >> 3] >> (s & 7) & 1 for s in _slots(word, size))

        return Cache(holds)


# -- passes -------------------------------------------------------------------------

_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_MENTION = pa.struct([("entity", pa.string()), ("term", pa.string()), ("place", pa.int64()), ("n", pa.int64())])


def _find_mentions(batches):
    for batch in batches:
        spans, near, counts = [], [], []
        for text in batch.column("text").to_pylist():
            text = text or ""
            own = base_spans(text)
            spans.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
            near.append([dict(zip(("entity", "term", "place", "n"), row)) for row in surroundings(text, own)] if own else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(spans, pa.list_(_SPAN)),
             pa.array(near, pa.list_(_MENTION))], ["doc_id", "key", "spans", "near"])


def _count_words(table: WordTable):
    def run(batches):
        holds, stems = table.reader(), Cache(stem)
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update(_WORD.findall(text.lower()) if text.isascii() else [w.lower() for w in _WORD.findall(text)])
            out: Counter = Counter()
            for word, n in counts.items():
                if holds[word]:
                    out[word] += n
                if holds[stems[word]]:
                    out[stems[word]] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([*out, ""], pa.string()), pa.array([*out.values(), counts.total()], pa.int64())], ["term", "n"])
    return run


def _find_terms(table: WordTable):
    def run(batches):
        holds = table.reader()
        for batch in batches:
            ids, keys, terms, starts, ends = [], [], [], [], []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
                if not text or not any(holds[w.lower()] for w in set(_WORD.findall(text))):
                    continue
                for word, start, end in words_outside(text, base_spans(text)):
                    if holds[word]:
                        ids.append(doc_id)
                        keys.append(key)
                        terms.append(word)
                        starts.append(start)
                        ends.append(end)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(terms, pa.string()),
                 pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], ["doc_id", "key", "term", "start", "end"])
    return run


def disclosure(near: DataFrame, counts: DataFrame, words: int, threshold: float = THRESHOLD) -> DataFrame:
    """(term, disclosed): each counted term's largest share of any entity's information.

    ``near`` has (entity, term, n, places), ``counts`` (term, n), ``words`` the corpus's
    word positions.
    """
    # Written, so that Spark can split an entity that stands beside very many words.
    size = materialize(near.where(~F.col("term").endswith("*")).groupBy("entity")
                       .agg(F.sum("n").alias("beside")), "beside")
    beside = (near.where(F.col("places") >= SUPPORT)
              .join(counts.select("term", F.col("n").alias("of_term")), "term").join(size, "entity"))
    p_entity = F.ln(F.col("beside") / F.lit(float(words)))
    # An entity beside every word of the corpus has no information to give away.
    share = F.when(p_entity < 0, 1 - F.ln(F.least(F.lit(1.0), F.col("n") / F.col("of_term"))) / p_entity).otherwise(0.0)
    return beside.groupBy("term").agg(F.max(share).alias("disclosed")).select(
        "term", "disclosed", (F.col("disclosed") >= threshold).alias("reveals"))


def find_pii(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, key (hash of the text), base (spans), terms (spans with their replacement).

    Rows of one id and text are alike and each get their own row.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("key"), F.col(text_col).alias("text"))
    found = materialize(source.mapInArrow(
        _find_mentions, "doc_id long, key long, spans array<struct<start: bigint, kind: int, end: bigint>>,"
                        " near array<struct<entity: string, term: string, place: bigint, n: bigint>>"), "pii")
    # The same surroundings are counted with their copies, but stand for one place.
    near = materialize(
        found.select(F.explode("near").alias("m")).select("m.*")
        .groupBy("entity", "term", "place").agg(F.sum("n").alias("n"))
        .groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("places")), "near")
    often = near.where(F.col("places") >= SUPPORT).select("term").distinct()
    counts = materialize(source.select("text").mapInArrow(_count_words(WordTable(often, "term")), "term string, n long")
                         .groupBy("term").agg(F.sum("n").alias("n")), "counts")
    words = counts.where(F.col("term") == "").agg(F.sum("n")).first()[0] or 0
    shares = materialize(disclosure(near, counts, words, threshold), "shares")
    revealing = shares.where(F.col("reveals") & ~F.col("term").endswith("*")).select("term")
    # A stem that came up too rarely beside any entity discloses none.
    stems = shares.where(F.col("reveals") & F.col("term").endswith("*")).select(F.col("term").alias("stem"))
    stem_of = F.concat(F.substring("term", 1, STEM), F.lit("*"))
    actions = (revealing.withColumn("stem", stem_of).join(stems.withColumn("_bad", F.lit(True)), "stem", "left")
               .select("term", F.when(F.col("_bad").isNull(), F.col("stem")).otherwise("").alias("replacement")))
    hits = source.mapInArrow(_find_terms(WordTable(revealing, "term")),
                             "doc_id long, key long, term string, start long, end long")
    span = F.struct("start", F.lit(len(KINDS)).alias("kind"), "end", "replacement")
    terms = (hits.join(actions, "term").groupBy(F.coalesce("doc_id", F.lit(0)).alias("_doc"), F.col("doc_id").isNull().alias("_null"), "key")
             .agg(F.sort_array(F.collect_set(span)).alias("terms")))
    same = ((F.coalesce("doc_id", F.lit(0)) == F.col("_doc")) & (F.col("doc_id").isNull() == F.col("_null"))
            & (found["key"] == terms["key"]))
    empty = F.array().cast("array<struct<start: bigint, kind: int, end: bigint, replacement: string>>")
    return (found.drop("near").join(terms, same, "left")
            .select("doc_id", found["key"], F.col("spans").alias("base"), F.coalesce("terms", empty).alias("terms")))


def spans_text(spans: F.Column) -> F.Column:
    """kind:start:end of sorted spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in (*KINDS, TERM)])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def sanitise(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with base spans replaced by their kind in brackets, terms generalised or removed.

    Of overlapping base spans the first is replaced and the rest of the others cut.
    """
    change = fresh_name(docs.columns, "_change")
    found = find_pii(docs, text_col, id_col, threshold)
    changes = found.where(F.size("base") + F.size("terms") > 0).select(
        "doc_id", "key",
        F.concat(F.transform("base", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.concat(F.lit("["), F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), F.lit("]")).alias("to"))),
            F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["replacement"].alias("to")))
        ).alias("spans")).dropDuplicates(["doc_id", "key"]).select(F.struct("*").alias(change))
    same = ((F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(change)["key"])
            & F.col(id_col).cast("long").eqNullSafe(F.col(change)["doc_id"]))
    joined = docs.join(changes, same, "left")

    @F.pandas_udf("string")
    def rewrite(texts, all_spans):
        out = []
        for text, found_here in zip(texts, all_spans):
            if text is not None and found_here is not None and len(found_here):
                parts, end = [], 0
                for s in sorted(found_here, key=lambda s: (s["start"], s["end"])):
                    if s["start"] >= end:
                        parts += [text[end:s["start"]], s["to"]]
                    end = max(end, s["end"])
                text = "".join([*parts, text[end:]])
            out.append(text)
        return pd.Series(out, dtype=object)

    return joined.withColumn(text_col, rewrite(F.col(text_col), F.col(change)["spans"])).drop(change)


def pii_digest(docs: DataFrame) -> DataFrame:
    """The columns of query ``op11_pii``."""
    found = find_pii(docs)
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    merged = F.array_sort(F.concat("base", F.transform("terms", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))))
    return found.select(
        "doc_id", *[number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"), spans_text(merged).alias("spans"),
        F.size("terms").cast("long").alias("n_term"))
