"""Quality rules with risk-controlled thresholds (operator 3).

Rules reject a document whose value lies above a cutoff. Cutoffs are chosen per
stratum (the document's lang) from labelled holdouts, so that with probability
``1 - CONFIDENCE_ERROR`` no stratum loses more than ``RISK`` of its good documents:
the risk is shared out over the rules, the error over strata and rules
(Bonferroni), and the cutoffs of one rule are tested in a fixed sequence from the
laxest on, each by the exact binomial tail, until one fails. Among the cutoffs
that pass, the one that rejects most bad documents for each good one lost is taken
(the laxest of equals). A rule without a passing cutoff is off in that stratum.

Text features are computed once and kept in a table; calibration sees one narrow
row a labelled document, counted in a histogram of fixed size per stratum.

Defined results: null and empty texts have no words and fail the base rule; a null
and an empty lang share one stratum; without labels no rule is on; of several labels of
one document a good one counts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import gram_hashes, hash_words, materialize

MIN_WORDS = 10
WINDOW = 5
RISK = 0.02
CONFIDENCE_ERROR = 0.05
#: Cutoffs tried per rule: i / STEPS of the rule's scale, for i from STEPS down to 0.
STEPS = 100
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


def rules() -> dict[str, Column]:
    """Values between 0 and 1 that rise with junk."""
    share = lambda a, b: F.least(F.col(a) / F.greatest(F.col(b), F.lit(1)), F.lit(1.0))
    return {
        "symbols": share("n_symbols", "word_chars"),
        "marks": share("n_marks", "word_chars"),
        "capitals": share("n_upper", "word_chars"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
    }


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more."""
    grams = gram_hashes(hash_words(words), window)
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    if len(counts) == len(grams):
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(counts[inverse] > 1)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + window, -1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> list[int]:
    """The counts of ``_COUNTS``."""
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return [len(words), len(text) - sum(map(text.count, _SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            len(text) - len(text.translate(_CAPITALS)), text.count("!")]


_CAPITALS = {c: None for c in range(65, 91)}


def text_counts(text: Column) -> Column:
    """Struct of long counts of a text."""

    @F.arrow_udf(", ".join(f"{n} long" for n in _COUNTS))
    def count(texts: pa.Array) -> pa.Array:
        rows = np.array([measure(t) for t in texts.to_pylist()], np.int64).reshape(-1, len(_COUNTS))
        return pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(_COUNTS))], _COUNTS)

    return count(text)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial variable, exactly summed."""
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
            + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def choose_cutoff(good: np.ndarray, bad: np.ndarray, risk: float, error: float) -> float:
    """Cutoff for histograms of good and bad values by step; infinity if none is certified.

    ``good[i]`` and ``bad[i]`` count values in (i - 1, i] / STEPS (0: exactly 0).
    """
    n = int(good.sum())
    lost = np.concatenate([np.cumsum(good[::-1])[::-1][1:], [0]])  # above cutoff i
    caught = np.concatenate([np.cumsum(bad[::-1])[::-1][1:], [0]])
    best, gain = math.inf, 0.0
    for i in range(len(good) - 1, -1, -1):
        if n == 0 or binomial_tail(int(lost[i]), n, risk) > error:
            break
        value = caught[i] / max(1, bad.sum()) - lost[i] / n
        if value > gain + 1e-12:
            best, gain = i / STEPS, value
    return best


def calibrate(features: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, one cutoff a rule) from features (doc_id, stratum, counts, base_failed) and labels."""
    names = list(rules())
    truth = (labels.filter("quality is not null").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.max("quality").alias("good")))
    steps = F.array(*[F.ceil(v * STEPS).cast("int") for v in rules().values()])
    marked = (features.filter(~F.col("base_failed")).select("doc_id", "stratum", steps.alias("steps"))
              .join(truth, F.col("doc_id") == F.col("_id")))
    counts = (marked.select("stratum", "good", F.posexplode("steps").alias("rule", "step"))
              .groupBy("stratum", "rule", "step", "good").agg(F.count(F.lit(1)).alias("n")))
    counts = materialize(counts, "histogram")
    strata = counts.select("stratum").distinct().count()
    risk, error = RISK / len(names), CONFIDENCE_ERROR / (max(1, strata) * len(names))

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"stratum": [rows["stratum"].iloc[0]]}
        for i, name in enumerate(names):
            own = rows[rows["rule"] == i]
            both = [np.bincount(own["step"][own["good"] == g], own["n"][own["good"] == g], STEPS + 1) for g in (1, 0)]
            out[name] = [choose_cutoff(*both, risk, error)]
        return pd.DataFrame(out)

    return counts.groupBy("stratum").applyInPandas(choose, "stratum string, " + ", ".join(f"{n} double" for n in names))


def judge(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, n_words, base counts, base_failed, kept of each row."""
    features = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat(F.lit("lang "), F.coalesce(F.col("lang").cast("string"), F.lit(""))).alias("stratum"),
        text_counts(F.col(text_col)).alias("_c")).select("doc_id", "stratum", "_c.*")
    features = materialize(features.withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))), "features")
    cutoffs = calibrate(features, labels)
    cutoffs = cutoffs.select(F.col("stratum").alias("_stratum"), *[F.col(n).alias(f"_{n}") for n in rules()])
    passed = F.lit(True)
    for name, value in rules().items():
        passed = passed & (F.ceil(value * STEPS) <= F.coalesce(F.col(f"_{name}") * STEPS, F.lit(float(STEPS))))
    return (features.join(cutoffs, F.col("stratum") == F.col("_stratum"), "left")
            .select("doc_id", *_COUNTS[:5], "base_failed", (~F.col("base_failed") & passed).alias("kept")))
