"""Toxicity by noisy-channel deobfuscation (operator 4).

Writers hide words by look-alike characters (1d10t), by spacing letters out
(i d i o t, i.d.i.o.t) and by repeating them (idiooot). Every token that may hide
one becomes a lattice: each character offers what it may stand for, a repeated
letter may go, a gap between single letters may go or stay, a look-alike at an end of
a token is a letter or decoration. Viterbi decoding under a character trigram model
finds the likeliest reading; the restored words are what is scored. A token of letters
keeps its own reading beside the restored one. Tokens without look-alikes, doubled
letters and gaps have one reading and skip the lattice.

The character model counts all texts, by tasks that each hand on one table of
fixed size. The classifier is a logistic regression on the presence of at most
``LEXICON`` words, learned from about ``SAMPLE`` labelled documents a class
(``stratified_sample``); class weights undo the sampling. No label, lang, source or
id is an input of a score.

Defined results: null and empty texts have the score of a text without lexicon
words; without labels of both classes every score is 0.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import Cache, materialize, serve, stored, stratified_sample

SAMPLE = 6000
LEXICON = 512
MIN_DOCUMENTS = 3
MIN_Z = 4.0
#: Letters that look-alike characters may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
#: Log10 costs of the channel: a look-alike read as itself, a gap kept.
_LITERAL, _KEPT_GAP = -2.0, -0.5
#: That of dropping a look-alike at an end; a closing ! and longer runs are decoration.
_DROPPED, _DECORATION = -2.0, 3
_SIZE = 32
_EDGE, _LETTER, _DIGIT, _MARK = 0, 27, 28, 29
_SPACED = re.compile(r"(?<!\S)(\S)\1*+(?:\s++(\S)\2*+(?!\S)){2,}")
_DOTTED = re.compile(r"\w(?:[.\-_*~]\w){2,}")
_REPEATED = re.compile(r"([^\W\d_])\1")
_HIDDEN = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
_OUTER = ".,;:!?\"'()[]{}<>*#%&|/\\-_~`^=+"
_STRIP = _OUTER + "$@"


def _symbols() -> np.ndarray:
    out = np.full(256, _MARK, np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = _EDGE
    out[0x30:0x3A] = _DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = np.arange(1, 27)
    out[0x80:] = _LETTER
    return out


_SYMBOL = _symbols()


def _symbol(char: str) -> int:
    return int(_SYMBOL[ord(char)]) if ord(char) < 128 else _LETTER


def character_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts of the symbols of all texts (texts begin and end at an edge)."""

    def count(batches):
        serve("toxicity")
        total = np.zeros(_SIZE ** 3, np.int64)
        edge = np.zeros(2, np.uint8)
        for batch in batches:
            for text in batch.column("_text").cast(pa.binary()).to_pylist():
                own = np.concatenate([edge, _SYMBOL[np.frombuffer(text or b"", np.uint8)], edge[:1]]).astype(np.int32)
                total += np.bincount(own[:-2] * _SIZE ** 2 + own[1:-1] * _SIZE + own[2:], minlength=_SIZE ** 3)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["gram", "n"])

    rows = (docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "gram long, n long")
            .groupBy("gram").agg(F.sum("n").alias("n")).collect())  # at most 32**3 rows
    out = np.zeros(_SIZE ** 3)
    for gram, n in rows:
        out[gram] = n
    return out.reshape(_SIZE, _SIZE, _SIZE)


def character_model(counts: np.ndarray) -> np.ndarray:
    """Log10 probabilities of an interpolated (Witten-Bell) trigram model."""
    lower = np.full(_SIZE, 1.0 / _SIZE)
    for level in (counts.sum(axis=(0, 1)), counts.sum(axis=0), counts):
        total, kinds = level.sum(axis=-1, keepdims=True), (level > 0).sum(axis=-1, keepdims=True)
        lower = np.where(total > 0, (level + kinds * lower) / np.maximum(total + kinds, 1), lower)
    return np.log10(lower)


def _drop_costs(end: str, closing: bool) -> list[float]:
    out = []
    for char, run in itertools.groupby(end):
        size = len(list(run))
        out += [0.0 if closing and char == "!" or size >= _DECORATION else _DROPPED] * size
    return out


def lattice(token: str, lead: int = 0, trail: int = 0) -> list[list[tuple[str, float]]]:
    """Per character, what it may stand for and the channel's log10 cost.

    The first ``lead`` and the last ``trail`` characters are look-alikes that may go.
    """
    out = []
    inner = len(token) - lead - trail
    drop = _drop_costs(token[:lead], False) + [0.0] * inner + _drop_costs(token[lead + inner:], True)
    for i, char in enumerate(token):
        if not lead <= i < lead + inner:
            out.append([("", drop[i])] + [(c, 0.0) for c in LOOKALIKES[char]])
        elif char == " " or char in ".-_*~" and 0 < i < len(token) - 1:
            out.append([("", 0.0), (char, _KEPT_GAP)])
        elif char in LOOKALIKES:
            out.append([(c, 0.0) for c in LOOKALIKES[char]] + [(char, _LITERAL)])
        elif i and token[i - 1] == char:
            out.append([("", 0.0), (char, 0.0)])
        else:
            out.append([(char, 0.0)])
    return out


def decode(token: str, model: np.ndarray, lead: int = 0, trail: int = 0) -> str:
    """Likeliest reading of the lattice of ``token``."""
    states = {(_EDGE, _EDGE): (0.0, None)}
    for column in lattice(token, lead, trail):
        reached: dict = {}
        for (a, b), (score, path) in states.items():
            for reading, cost in column:
                if reading:
                    symbol = _EDGE if reading == " " else _symbol(reading)
                    key, value = (b, symbol), score + cost + model[a, b, symbol]
                    step = (path, reading)
                else:
                    key, value, step = (a, b), score + cost, path
                if key not in reached or value > reached[key][0]:
                    reached[key] = (value, step)
        states = reached
    _, path = max(((s + model[a, b, _EDGE], p) for (a, b), (s, p) in states.items()), key=lambda x: x[0])
    out = []
    while path:
        path, reading = path
        out.append(reading)
    return "".join(reversed(out))


class Restorer:
    """Restored words of texts under a character model."""

    def __init__(self, model: np.ndarray):
        self.table = _Table(model.tolist())
        self.word = Cache(self._word)

    def _word(self, token: str) -> tuple[str, ...]:
        plain = token.strip(_STRIP)
        if not any(c.isalpha() for c in plain):
            return (plain,)
        at = token.index(plain)
        lead, trail = ("".join(c for c in end if c in LOOKALIKES) for end in (token[:at], token[at + len(plain):]))
        if not (lead or trail or _HIDDEN.search(plain) or _REPEATED.search(plain) or _DOTTED.fullmatch(plain)):
            return (plain,)
        restored = decode(lead + plain + trail, self.table, len(lead), len(trail)).strip(_STRIP)
        return (plain, restored) if plain.isalpha() else (restored,)

    def words(self, text: str | None) -> set[str]:
        text = (text or "").lower()
        found = set().union(*map(self.word.__getitem__, set(text.split())))
        for run in _SPACED.finditer(text):
            found.update(decode(" ".join(run.group().split()), self.table).split())
        return found


class _Table:
    """Nested lists read as table[a, b, c]."""

    def __init__(self, rows):
        self.rows = rows

    def __getitem__(self, key):
        a, b, c = key
        return self.rows[a][b][c]


_OWN: list = [None, None]
stored(lambda: _OWN.__setitem__(slice(None), [None, None]))


def _restorer(model: np.ndarray) -> Restorer:
    mark = hash(model.tobytes())
    if _OWN[0] != mark:
        _OWN[:] = mark, Restorer(model)
    return _OWN[1]


def restored_words(text: Column, model: np.ndarray) -> Column:
    """Distinct restored words of a text."""

    @F.arrow_udf("array<string>")
    def words(texts: pa.Array) -> pa.Array:
        serve("toxicity")
        own = _restorer(model)
        return pa.array([sorted(own.words(t) - {""}) for t in texts.to_pylist()], pa.list_(pa.string()))

    return words(text)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Intercept and weights, by Newton steps on the weighted, ridged likelihood."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weight = weight * len(y) / weight.sum()
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    out = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * out
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        out += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return out


def train(docs: DataFrame, labels: DataFrame, model: np.ndarray, text_col: str = "text",
          per_class: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(lexicon, intercept and weights) from labelled training documents (doc_id, text)."""
    truth = (labels.filter("toxic is not null").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max("toxic").cast("int").alias("_toxic")))
    ids = docs.select(F.col("doc_id").alias("_doc")).join(truth, F.col("_doc") == F.col("_id")).select("_doc", "_toxic")
    ids = materialize(ids.filter("_toxic in (0, 1)"), "toxic-labels")
    sizes = {r["_toxic"]: r["count"] for r in ids.groupBy("_toxic").count().collect()}
    if len(sizes) < 2:
        return [], np.zeros(0)
    drawn = stratified_sample(ids, "_toxic", "_doc", per_class).distinct()
    sample = docs.select("doc_id", F.col(text_col).alias("_text")).join(
        F.broadcast(drawn), F.col("doc_id") == F.col("_doc"))  # bounded by ``per_class``
    words = materialize(sample.select("_toxic", restored_words(F.col("_text"), model).alias("words")), "toxic-words")
    drawn = {r["_toxic"]: r["count"] for r in words.groupBy("_toxic").count().collect()}
    if len(drawn) < 2:
        return [], np.zeros(0)
    by_word = (words.select("_toxic", F.explode("words").alias("word")).groupBy("word")
               .agg(F.sum("_toxic").alias("t"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCUMENTS))
    rate_t = F.col("t") / drawn[1]
    rate_c = (F.col("n") - F.col("t")) / drawn[0]
    pooled = F.col("n") / (drawn[0] + drawn[1])
    z = (rate_t - rate_c) / F.sqrt(pooled * (1 - pooled) * (1 / drawn[0] + 1 / drawn[1]) + 1e-12)
    chosen = (by_word.withColumn("z", z).filter(F.abs("z") >= MIN_Z)
              .orderBy(F.abs("z").desc(), "word").limit(LEXICON).select("word").collect())
    lexicon = sorted(r["word"] for r in chosen)
    if not lexicon:
        return [], np.array([np.log(sizes[1] / sizes[0])])
    places = {w: i for i, w in enumerate(lexicon)}
    rows = words.select("_toxic", F.array_intersect("words", F.array(*map(F.lit, lexicon))).alias("w")).collect()
    x = np.zeros((len(rows), len(lexicon)), np.float32)
    for i, row in enumerate(rows):
        x[i, [places[w] for w in row["w"]]] = 1
    y = np.array([r["_toxic"] for r in rows], float)
    weight = np.where(y == 1, sizes[1] / drawn[1], sizes[0] / drawn[0])
    return lexicon, fit_logistic(x, y, weight)


def toxicity_score(text: Column, model: np.ndarray, lexicon: list[str], weights: np.ndarray) -> Column:
    if not len(weights):
        return F.lit(0.0)
    by_word = dict(zip(lexicon, weights[1:].tolist()))
    intercept = float(weights[0])

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        serve("toxicity")
        own = _restorer(model)
        sums = [intercept + sum(by_word[w] for w in sorted(own.words(t) & by_word.keys())) for t in texts.to_pylist()]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(sums, float), -40, 40))), pa.float64())

    return score(text)


def with_toxicity(docs: DataFrame, labels: DataFrame, training: Column, text_col: str = "text",
                  out: str = "_toxicity") -> DataFrame:
    """``docs`` with ``out`` (in place of a column of that name): each row's score, learned from ``training`` rows."""
    model = character_model(character_counts(docs, text_col))
    lexicon, weights = train(docs.filter(training), labels, model, text_col)
    return docs.withColumn(out, toxicity_score(F.col(text_col), model, lexicon, weights))


def toxicity_digest(docs: DataFrame, labels: DataFrame, training: Column) -> DataFrame:
    """The columns of query ``op4_toxicity``."""
    return with_toxicity(docs.select("doc_id", "text"), labels, training).select(
        "doc_id", (~training).alias("held_out"), F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"))
