"""Operators 2, 3, 4, 5, 8 and 10: one result a row, held against brute force."""

import collections
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from activity_engine.llm import bpe, language_id, lm_scoring, quality_rules, token_orc, toxicity
from activity_engine.llm.common import Cache, crc_mod

from .conftest import EDGES

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
TOKENS = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


# -- op10 ---------------------------------------------------------------------------

@hypothesis_settings(max_examples=150, deadline=None)
@given(st.text(max_size=120) | st.text(alphabet="ab  \n'stlmvreéd漢1!.<|>", max_size=200))
def test_bpe_is_the_library(text):
    library = Tokenizer.from_file(BYTES)
    ids = library.encode(text, add_special_tokens=False).ids
    joined, own = bpe.codec(BYTES).encode(text)
    assert own.tolist() == ids and joined == ",".join(map(str, ids))
    assert bpe.codec(BYTES).decode(own) == library.decode(ids, skip_special_tokens=False)


def test_bpe_rows(edges, no_docs):
    import hashlib
    library = Tokenizer.from_file(BYTES)
    want = []
    for i, text in EDGES:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    got = rows_of(bpe.with_bpe(edges, BYTES), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(want, key=str)
    back = edges.select("text", bpe.bpe_decode(bpe.bpe_ids(F.col("text"), BYTES), BYTES).alias("back"))
    assert all(r.back == (r.text or "") for r in back.collect())
    assert bpe.with_bpe(no_docs, BYTES).count() == 0


def test_cache_keeps_what_is_used():
    made = []
    cache = Cache(lambda k: made.append(k) or k, limit=3)
    for key in [1, 2, 1, 3, 4, 1, 5, 6, 1]:
        assert cache[key] == key
    assert made.count(1) == 1 and len(cache) <= 3


# -- op5 ----------------------------------------------------------------------------

@hypothesis_settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab AB \n'stlmvreéßÿd漢1!.<|>́\x1c", max_size=120))
def test_word_ids_are_the_library(text):
    want = Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids
    got = token_orc.encoder(WORDS).encode([text.encode("utf-8", "ignore")])[0]
    assert np.frombuffer(got, "<i4").tolist() == want + [token_orc.END_ID]


def test_orc_files(spark, edges, no_docs, tmp_path):
    docs = edges.filter("doc_id is null or doc_id <> 5")
    token_orc.write_tokens(docs, str(tmp_path / "a"), WORDS)
    got = {r.doc_id: r for r in token_orc.read_digest(spark, str(tmp_path / "a")).collect() if r.doc_id}
    library, start = Tokenizer.from_file(WORDS), 0
    ordered = sorted((r for r in EDGES if r[0] != 5), key=lambda r: (r[0] is not None, r[0] or 0))
    for i, text in ordered:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        if i is not None:
            crc = zlib.crc32(np.array(ids, "<u4").tobytes())
            assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)
    found = token_orc.find_documents(spark, str(tmp_path / "a"), [6, 11])
    assert sorted(r.doc_id for r in found.collect()) == [6, 11]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan
    again = [(7, "one two three four five six"), (7, "one"), (7, "one two three"), (3, "a"), (3, "a"), (9, None)]
    token_orc.write_tokens(spark.createDataFrame(again, "doc_id long, text string"), str(tmp_path / "c"), WORDS)
    stored = token_orc.read_tokens(spark, str(tmp_path / "c")).select("doc_id", "ids", "_metadata.file_name").collect()
    start, want = 0, []
    for r in sorted(stored, key=lambda r: r.file_name):          # rows of one file come in its order
        want.append((r.doc_id, start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())))
        start += len(r.ids)
    assert rows_of(token_orc.read_digest(spark, str(tmp_path / "c")), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)
    token_orc.write_tokens(no_docs, str(tmp_path / "b"), WORDS)
    assert token_orc.read_digest(spark, str(tmp_path / "b")).count() == 0


# -- op2 ----------------------------------------------------------------------------

def test_gradients():
    network = language_id.Network(["a", "b", "c"], hidden=3)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    rng = np.random.default_rng(0)
    data, truth = rng.integers(97, 102, (5, 4)).astype(np.uint8), rng.integers(0, 3, 4)
    _, grads = network.gradients(data, truth)
    for name, w in network.weights.items():
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        w[at] += 1e-3
        above = network.gradients(data, truth)[0]
        w[at] -= 2e-3
        below = network.gradients(data, truth)[0]
        w[at] += 1e-3
        assert abs(grads[name][at] - (above - below) / 2e-3) < 1e-5


def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_digest(docs, crc_mod("doc_id", 5) != 0).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out")
    assert held.filter("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.filter("score < 0 or score > 1").count() == 0


def test_language_edges(edges, no_docs):
    got = language_id.language_digest(edges, F.lit(True)).collect()
    assert {r.lang_pred for r in got} == {"en", "und"}
    assert sum(r.lang_pred == "und" and r.score == 0 for r in got) == sum(
        not any(c.isalpha() for c in t or "") for _, t in EDGES)
    assert {r.lang_pred for r in language_id.language_digest(edges, F.lit(False)).collect()} == {"und"}
    assert language_id.language_digest(no_docs, F.lit(True)).count() == 0


# -- op3 ----------------------------------------------------------------------------

def base_counts(text):
    words = TOKENS.findall(text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    inside = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines, copies = set(), 0
    for line in (text or "").split("\n"):
        if TOKENS.search(line):
            copies += line in lines
            lines.add(line)
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, copies, len(inside), failed


def test_quality_counts(spark, edges, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, None, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = rows_of(quality_rules.judge(edges, labels), "doc_id", "n_words", "word_chars", "n_symbols",
                  "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(((i, *base_counts(t)) for i, t in EDGES), key=str)
    assert quality_rules.judge(no_docs, labels.limit(0)).count() == 0


def test_exact_bounds():
    assert quality_rules.binomial_tail(0, 100, 0.05) == pytest.approx(0.95 ** 100)
    assert quality_rules.binomial_tail(2, 5, 0.3) == pytest.approx(
        sum(math.comb(5, i) * 0.3 ** i * 0.7 ** (5 - i) for i in range(3)))
    good, bad = np.zeros(101, int), np.zeros(101, int)
    good[0], good[30], bad[80] = 3000, 2, 50
    assert 0.3 <= quality_rules.choose_cutoff(good, bad, 0.01, 0.01) < 0.8  # keeps all good ones, rejects the bad
    good[0] = 20  # too few to certify anything
    assert quality_rules.choose_cutoff(good, bad, 0.01, 0.01) == math.inf


def test_quality_rules_reject_junk_and_keep_clean(spark):
    clean = [(i, " ".join(f"w{i}x{j}" for j in range(20)), "en") for i in range(3000)]
    junk = [(5000 + i, " ".join(f"w{i}y{j}%%%" for j in range(20)), "en") for i in range(100)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") < 5000).cast("int").alias("quality"))
    got = quality_rules.judge(docs, labels).groupBy(F.col("doc_id") < 5000, "kept").count().collect()
    assert {(r[0], r["kept"]): r["count"] for r in got} == {(True, True): 3000, (False, False): 100}


# -- op4 ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    counts = np.zeros((32, 32, 32))
    for word in ["idiot", "clown", "pathetic", "worthless", "moron", "the", "and"] * 30:
        own = [0, 0, *[ord(c) - 96 for c in word], 0]
        for a, b, c in zip(own, own[1:], own[2:]):
            counts[a, b, c] += 1
    return toxicity.character_model(counts)


@pytest.mark.parametrize("hidden, word", [
    ("1d10t", "idiot"), ("i d i o t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooot", "idiot"), ("cl0wn", "clown"),
    ("p4thet1c", "pathetic"), ("w0rthle$$", "worthless"), ("m0r0n", "moron"), ("the", "the")])
def test_restores(model, hidden, word):
    assert toxicity.decode(hidden, model) == word
    assert word in toxicity.Restorer(model).words(f"and {hidden} and")


@pytest.mark.parametrize("hidden, word", [
    ("!diot", "idiot"), ("|d10t!", "idiot"), ("!!!idiot!!!", "idiot"), ("idio+", "idiot"), ("(+he)", "the"),
    ("@nd", "and"), ("worthle$$!", "worthless"), ("iddiioott", "idiot"), ("moronn", "moron"), ("worthless", "worthless"),
    ("i  d i o t", "idiot"), ("i\td\ni  o\tt", "idiot"), ("i dd i oo t", "idiot"), ("ii d i o tt", "idiot"),
    ("clown!", "clown"), ("clown|", "clown"), ("hello", "hello"), ("$$$clown$$$", "clown")])
def test_restores_outer_doubled_and_spaced(model, hidden, word):
    assert word in toxicity.Restorer(model).words(f"and {hidden} and")


def test_model_is_a_distribution(model):
    assert np.allclose((10.0 ** model).sum(axis=-1), 1)


def test_toxicity_learns(spark, edges, no_docs):
    rows = [(i, f"w{i} and w{i % 7} " + ("idiot clown" if i % 4 == 0 else "friend")) for i in range(400)]
    rows += [(1000, "you 1d10t"), (1001, "you c l o w n"), (1002, "you friend")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity_digest(docs, labels, crc_mod("doc_id", 5) != 0).collect()}
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(400))
    assert (got[1000].predicted, got[1001].predicted, got[1002].predicted) == (1, 1, 0)
    edge = toxicity.toxicity_digest(edges, labels, F.lit(True)).collect()
    assert len(edge) == len(EDGES) and all(0 <= r.score <= 1 for r in edge)
    assert toxicity.toxicity_digest(no_docs, labels, F.lit(True)).count() == 0


# -- op8 ----------------------------------------------------------------------------

def brute_scores(rows, train):
    tok = lambda t: (t or "").encode().lower().split() + [b" "]
    count = collections.Counter(w for t in train for w in tok(t))
    total, distinct = sum(count.values()), len(count)
    frequent = {w for w, n in count.items() if n * 2 ** lm_scoring.WORD_BITS >= total}
    kept = {}
    for order in (2, 3):
        seen = collections.Counter()
        for t in train:
            w = tok(t)
            for g in zip(*(w[i:] for i in range(order))):
                if all(x in frequent for x in g) and (order == 2 or g[:-1] in kept and g[1:] in kept):
                    seen[g] += 1
        kept |= {g: n for g, n in seen.items() if n * 2 ** lm_scoring.NGRAM_BITS >= total}
    of = lambda g: count[g[0]] if len(g) == 1 else kept[g]
    rest = collections.defaultdict(lambda: 1.0)
    for g, n in kept.items():
        rest[g[:-1]] -= (n - lm_scoring.DISCOUNT) / of(g[:-1])

    def p(context, word):
        if not context:
            return (count[word] + 1) / (total + distinct + 1)
        if context not in rest:
            return p(context[1:], word)
        own = (kept[context + (word,)] - lm_scoring.DISCOUNT) / of(context) if context + (word,) in kept else 0
        return own + rest[context] * p(context[1:], word)

    out = []
    for t in rows:
        w = tok(t)
        out.append((len(w), sum(count[x] > 0 for x in w), total, sum(math.log10(p((), x)) for x in w),
                    sum(math.log10(p(tuple(w[max(0, i - 2):i]), x)) for i, x in enumerate(w))))
    return out


def test_scores_by_brute_force(spark):
    texts = [None, "", "a b a b c", "A  b a b", "a b c d e f g", "zz yy", "a b a b c d a b"] * 4 + ["q r s", "a q b"]
    docs = spark.createDataFrame([(i, t, i < 28) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs, F.col("train")).collect()}
    for i, want in enumerate(brute_scores(texts, texts[:28])):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and r.held_out == (i >= 28)
        assert r.base_score == pytest.approx(want[3]) and r.score == pytest.approx(want[4])


def test_score_edges(edges, no_docs):
    got = lm_scoring.lm_scores(edges, F.lit(True)).collect()
    assert len(got) == len(EDGES) and all(r.score < 0 for r in got)
    unseen = lm_scoring.lm_scores(edges, F.lit(False)).collect()
    assert all(r.n_known == 0 and r.score == 0 for r in unseen)
    assert lm_scoring.lm_scores(no_docs, F.lit(True)).count() == 0


def test_every_ngram_counts_in_a_large_corpus(spark, monkeypatch):
    """Over 2**20 tokens: n-grams and words seen once are under every relative threshold."""
    rnd = random.Random(5)
    texts = [" ".join(f"w{int(1 / (1 - rnd.random()))}" for _ in range(90_000)) for _ in range(13)]
    texts += ["w1 w2 unseen w1 w1 w2", texts[0][-3000:], "w1", ""]
    docs = spark.createDataFrame([(i, t, i < 12) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs.repartition(4), F.col("train")).collect()}
    monkeypatch.setattr(lm_scoring, "WORD_BITS", 60)
    monkeypatch.setattr(lm_scoring, "NGRAM_BITS", 60)
    scored = [0, *range(12, len(texts))]
    for i, want in zip(scored, brute_scores([texts[i] for i in scored], texts[:12])):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and r.held_out == (i >= 12)
        assert r.base_score == pytest.approx(want[3]) and r.score == pytest.approx(want[4])


@pytest.mark.parametrize("words, ngrams", [(20, 13), (6, 5), (0, 0)])
def test_scores_of_many_batches_and_parts(spark, monkeypatch, words, ngrams):
    """Frequent, numbered and rare words and states, whose arcs lie in many parts."""
    rnd = random.Random(6)
    texts = [" ".join(f"w{int(1 / (1 - rnd.random()))}" for _ in range(rnd.randrange(40))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, i < 45) for i, t in enumerate(texts)], "doc_id long, text string, train boolean")
    tables = []

    def recorded(df, *args, **more):
        tables.append(lm_materialize(df, *args, **more))
        return tables[-1]

    lm_materialize = lm_scoring.materialize
    with monkeypatch.context() as m:
        m.setattr(lm_scoring, "materialize", recorded)
        for name, value in (("WORD_BITS", words), ("NGRAM_BITS", ngrams), ("_BATCH", 90), ("_PART", 70)):
            m.setattr(lm_scoring, name, value)
        got = {r.doc_id: r for r in lm_scoring.lm_scores(docs.repartition(8), F.col("train")).collect()}
    monkeypatch.setattr(lm_scoring, "WORD_BITS", 60)
    monkeypatch.setattr(lm_scoring, "NGRAM_BITS", 60)
    for i, want in enumerate(brute_scores(texts, texts[:45])):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert r.base_score == pytest.approx(want[3]) and r.score == pytest.approx(want[4])
    _, batches, answers = tables
    assert batches.count() > 3 and answers.select("part").distinct().count() > 3


def test_no_row_a_token_is_written(spark, monkeypatch):
    """A batch asks for an arc once; what is written and shuffled are packed columns."""
    docs = spark.createDataFrame([(i, "a b c d e f g h " * 500) for i in range(10)], "doc_id long, text string")
    written = []

    def counted(df, *args, **more):
        written.append(lm_materialize(df, *args, **more))
        return written[-1]

    lm_materialize = lm_scoring.materialize
    monkeypatch.setattr(lm_scoring, "materialize", counted)
    got = lm_scoring.lm_scores(docs, F.lit(True)).collect()
    assert [r.n_tokens for r in got] == [4001] * 10
    assert sum(t.count() for t in written) < 1000


def test_distinct_arcs_of_many_words():
    u, v, w = np.random.default_rng(7).integers(0, 6, (3, 500))
    few, many = (lm_scoring._distinct(u, v, w, kinds) for kinds in (6, 1 << 23))
    assert np.array_equal(few[0], many[0]) and len(few[1]) == len(many[1])
    for place, at in (few, many):
        assert all(np.array_equal(x, x[at][place]) for x in (u, v, w))
