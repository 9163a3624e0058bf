"""Language identification by a bidirectional gated recurrent network over bytes (operator 2).

Two gated recurrent layers read the bytes of a window, one forwards and one
backwards; from both states every position gets language probabilities, and a
document's probabilities are their mean over all its positions. Trained in numpy by
backpropagation through time, on every position of sampled windows.

The classifier is fitted on a bounded sample: about ``DOCUMENTS`` training documents
a language (``stratified_sample``), ``WINDOWS`` windows of ``SPAN`` bytes of each;
only these reach the driver. Prediction reads whole texts, in windows of equal
length that tasks push through the network together.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if
there is nothing to learn from; case does not matter (texts are lower-cased).
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_engine.llm.common import stratified_sample

DOCUMENTS = 400
WINDOWS = 5
SPAN = 48
HIDDEN = 8
STEPS = 320
BATCH = 128
RATE = 0.02
#: Windows that go through the network together.
BLOCK = 4096
UNKNOWN = "und"
_ANY_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Byte-level bidirectional recurrent network with one label a position."""

    def __init__(self, labels: list[str], seed: int = 7, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        normal = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.weights = {f"{kind}{way}": normal(*shape) for way in "fb"
                        for kind, shape in (("x", (256, 3 * hidden)), ("u", (hidden, 3 * hidden)))}
        self.weights |= {"o": normal(2 * hidden, len(labels)), "c": np.zeros(len(labels), np.float32)}

    def _run(self, bytes_: np.ndarray, way: str, keep: bool):
        """States of all positions, time first; what backpropagation needs if ``keep``."""
        h = self.hidden
        x, u = self.weights["x" + way], self.weights["u" + way]
        span, rows = bytes_.shape
        states = np.empty((span, rows, h), np.float32)
        state, kept = np.zeros((rows, h), np.float32), []
        for t in range(span) if way == "f" else range(span - 1, -1, -1):
            given, own = x[bytes_[t]], state @ u
            gates = _sigmoid(given[:, :2 * h] + own[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h:] + r * own[:, 2 * h:])
            if keep:
                kept.append((t, state, z, r, new, own[:, 2 * h:]))
            state = new + z * (state - new)
            states[t] = state
        return states, kept

    def forward(self, bytes_: np.ndarray, keep: bool = False):
        ahead, behind = self._run(bytes_, "f", keep), self._run(bytes_, "b", keep)
        both = np.concatenate([ahead[0], behind[0]], axis=2)
        logits = both @ self.weights["o"] + self.weights["c"]
        logits -= logits.max(axis=2, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(axis=2, keepdims=True), both, ahead[1], behind[1]

    def gradients(self, bytes_: np.ndarray, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over positions and its gradients; bytes_ is (span, rows)."""
        h = self.hidden
        odds, both, *kept = self.forward(bytes_, keep=True)
        span, rows = bytes_.shape
        loss = -float(np.log(odds[:, np.arange(rows), truth] + 1e-9).mean())
        error = odds
        error[:, np.arange(rows), truth] -= 1
        error /= span * rows
        out = {"o": np.einsum("tri,trk->ik", both, error), "c": error.sum(axis=(0, 1))}
        to_states = error @ self.weights["o"].T
        for way, steps, part in (("f", kept[0], to_states[:, :, :h]), ("b", kept[1], to_states[:, :, h:])):
            u = self.weights["u" + way]
            du, dx = np.zeros_like(u), np.zeros_like(self.weights["x" + way])
            carry = np.zeros((rows, h), np.float32)
            for t, before, z, r, new, own in reversed(steps):
                d = part[t] + carry
                into = d * (1 - z) * (1 - new * new)
                dz, dr = d * (before - new) * z * (1 - z), into * own * r * (1 - r)
                inner = np.concatenate([dz, dr, into * r], axis=1)
                np.add.at(dx, bytes_[t], np.concatenate([dz, dr, into], axis=1))
                du += before.T @ inner
                carry = d * z + inner @ u.T
            out["u" + way], out["x" + way] = du, dx
        return loss, out

    def fit(self, windows: np.ndarray, truth: np.ndarray, steps: int = STEPS, rate: float = RATE, seed: int = 7) -> None:
        """Adam on class-balanced batches of windows (rows, span)."""
        rng = np.random.default_rng(seed)
        pools = [np.flatnonzero(truth == k) for k in range(len(self.labels))]
        pools = [p for p in pools if len(p)]
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(p, -(-BATCH // len(pools))) for p in pools])
            _, grads = self.gradients(windows[rows].T, truth[rows])
            speed = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                down = np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8
                self.weights[k] -= (speed * first[k] / (1 - 0.9 ** step) / down).astype(np.float32)

    def documents(self, texts: list[bytes], span: int = SPAN) -> np.ndarray:
        """Mean probabilities over the positions of each text (no text may be empty)."""
        sizes = np.array([len(t) for t in texts])
        counts = -(-sizes // span)
        owner = np.repeat(np.arange(len(texts)), counts)
        data = np.frombuffer(b"".join(t.ljust(n * span, b" ") for t, n in zip(texts, counts.tolist())), np.uint8)
        windows = data.reshape(-1, span)
        ends = np.cumsum(counts)
        used = np.full(len(windows), span)
        used[ends - 1] = sizes - (counts - 1) * span
        total = np.zeros((len(texts), len(self.labels)))
        for at in range(0, len(windows), BLOCK):
            block = np.ascontiguousarray(windows[at:at + BLOCK].T)
            odds = self.forward(block)[0]
            odds[np.arange(span)[:, None] >= used[at:at + BLOCK][None, :]] = 0
            np.add.at(total, owner[at:at + BLOCK], odds.sum(axis=0))
        return total / sizes[:, None]


def _prepare(text: str | None) -> bytes | None:
    """Lower-cased bytes, or nothing for a text without a letter."""
    if not text or not _ANY_LETTER.search(text):
        return None
    return text.lower().encode()


def sample_windows(docs: DataFrame, text_col: str = "text", span: int = SPAN, windows: int = WINDOWS) -> DataFrame:
    """(lang, window): windows at places drawn by a generator seeded with the text."""

    def cut(batches):
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("_text").to_pylist()):
                data = _prepare(text)
                if data is None:
                    continue
                rng = np.random.default_rng(zlib.crc32(data))
                for at in rng.integers(0, max(1, len(data) - span + 1), windows).tolist():
                    langs.append(lang)
                    found.append(data[at:at + span].ljust(span, b" "))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], ["lang", "window"])

    return docs.select("lang", F.col(text_col).alias("_text")).mapInArrow(cut, "lang string, window binary")


def train(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", per_language: int = DOCUMENTS,
          steps: int = STEPS) -> Network | None:
    """Network trained on the labelled rows of ``docs``; None if there are none."""
    sample = stratified_sample(docs.select(F.col("lang").cast("string").alias("lang"), F.col(id_col).alias("_id"),
                                           F.col(text_col).alias("_text")), "lang", "_id", per_language)
    rows = sorted((r["lang"], bytes(r["window"])) for r in sample_windows(sample, "_text").collect())
    if not rows:
        return None
    labels = sorted({lang for lang, _ in rows})
    out = Network(labels)
    truth = np.array([labels.index(lang) for lang, _ in rows])
    if len(labels) > 1:
        out.fit(np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, SPAN), truth, steps)
    return out


def identify(text: Column, network: Network | None) -> Column:
    """Struct (lang_pred, score) of a text."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        prepared = [_prepare(t) if network else None for t in texts.to_pylist()]
        at = [i for i, t in enumerate(prepared) if t]
        labels, scores = [UNKNOWN] * len(prepared), [0.0] * len(prepared)
        if at:
            odds = network.documents([prepared[i] for i in at])
            for i, row in zip(at, odds):
                labels[i], scores[i] = network.labels[int(row.argmax())], min(1.0, float(row.max()))
        return pa.StructArray.from_arrays([pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return predict(text)


def language_digest(docs: DataFrame, training: Column) -> DataFrame:
    """The columns of query ``op2_language_id``."""
    network = train(docs.filter(training))
    return (docs.select("doc_id", (~training).alias("held_out"), identify(F.col("text"), network).alias("_l"))
            .select("doc_id", "held_out", "_l.lang_pred", "_l.score"))
