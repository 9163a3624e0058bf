"""The pipeline's stages on a small fixture, held against brute-force versions."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from activity_engine.llm import bpe, common

from .conftest import EDGES, prose
from .test_group_operators import brute_contamination, brute_groups, brute_removal

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [(i, prose(i, 70)) for i in range(100, 160)]
    rows += [(200 + i, prose(100 + i, 70) + " extra") for i in range(10)]              # near copies
    rows += [(300 + i, prose(900, 120) + " " + prose(700 + i, 80)) for i in range(3)]  # a shared passage
    rows += [(400, prose(40, 20) + " " + prose(990, 15)), (401, "you idiot " + prose(41, 30))]
    rows += [(500 + i, f"{'idiot' if i % 2 else 'clown'} {prose(600 + i, 20)}") for i in range(40)]
    rows += EDGES
    path = tmp_path_factory.mktemp("docs")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(100, 160)] + [(500 + i, 1, 1) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(990, 15))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, stages = docs.columns, [f for _, f in corpus_pipeline.STAGES]
    assert len(stages) == 5

    clean = stages[0](spark, docs, folder)
    assert clean.columns == columns
    ids = [r.doc_id for r in clean.collect()]
    assert not any(i is not None and (i == 401 or 500 <= i < 540) for i in ids)
    assert {i for i, _ in EDGES} <= set(ids) and set(range(100, 160)) <= set(ids)
    clean = spark.createDataFrame(clean.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect(), docs.schema)

    rows = sorted(((r.doc_id, r.text) for r in clean.collect()))
    want = {rows[root][0] for root, _ in brute_groups([t for _, t in rows])}
    single = stages[1](spark, clean, folder)
    assert single.columns == columns and {r.doc_id for r in single.collect()} == want
    single = spark.createDataFrame(single.collect(), docs.schema)

    rows = [(r.doc_id, r.text) for r in single.collect() if len(r.text or "") < 20_000]
    short = single.filter(F.length("text").isNull() | (F.length("text") < 20_000))
    cut = {r.doc_id: r for r in stages[2](spark, short, folder).collect()}
    for (i, text), (_, _, _, digest) in zip(rows, brute_removal([t for _, t in rows], 400)):
        if text is None:
            assert cut[i].text is None
        elif text.isascii():
            assert hashlib.sha256(cut[i].text.encode()).hexdigest() == digest and cut[i].n_chars == len(cut[i].text)

    kept = {r.doc_id for r in stages[3](spark, short, folder).collect()}
    bad = brute_contamination(rows, [(1, prose(990, 15))])
    assert kept == {i for (i, _), b in zip(rows, bad) if not b[4]} and 400 not in kept

    last = stages[4](spark, short, folder)
    assert "ids_sha256" in last.columns and last.count() == len(rows)


def test_stages_keep_clashing_columns(spark, folder, edges):
    """Each filtering stage returns the values of columns that are called what it calls its own."""
    docs = edges.withColumn("text", F.when(F.col("doc_id") == 8, "short").otherwise(F.col("text")))
    for _, stage in corpus_pipeline.STAGES[:4]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r["_key"] == "_key" and r["_label"] == "_label" and r["_removal"] == "_removal"
                            and r["_toxicity"] == "_toxicity" and r["_head"] == "_head" for r in rows)


def test_run(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    ids = {r.doc_id for r in got.collect()}
    assert 400 not in ids and not ids & {401, *range(500, 540), *range(200, 210)} and {300, 301, 302} <= ids


def test_short_worded_passages_are_cut(spark):
    """Passages of 51 to 60 words in otherwise different documents have under 400 bytes; 50 words stay."""
    rows, want = [], {}
    for k, count in enumerate([50, 51, 53, 60]):
        passage = [w[1:] for w in prose(800 + k, count).split()]
        for side in range(2):
            before, after = prose(10 + 2 * k + side, 40) + f" é{side}", prose(50 + 2 * k + side, 40)
            gap = "\n" if side else " "
            rows.append((2 * k + side, f"{before} {gap.join(passage)} x{side} {after}"))
            want[2 * k + side] = rows[-1][1] if count == 50 else f"{before}  x{side} {after}"
            assert len(" ".join(passage)) < 300
    rows += [(90, None), (91, ""), (92, "a b " * 10), (93, "a b " * 10)]
    want |= {90: None, 91: "", 92: "a b " * 10, 93: "a b " * 10}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    cut = corpus_pipeline.cut_repeats(spark, docs, "")
    assert cut.columns == docs.columns and {r.doc_id: r.text for r in cut.collect()} == want


def test_a_worker_drops_what_the_last_operator_kept():
    path = public_tokenizers.path("byte_bpe_50k.json")
    common.serve("bpe")
    own = bpe.codec(path)
    common.hash_words([b"a", b"b"])
    common.serve("bpe")
    assert bpe.codec(path) is own and len(common._WORD_HASH) == 2    # the same operator finds it again
    common.serve("jaccard_join")
    assert bpe.codec.cache_info().currsize == 0 and not common._WORD_HASH and not common._WORD_HASH.last
