"""Operators 1, 6, 7 and 9: results over all rows, held against brute force."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activity_engine.llm import jaccard_join, suffix_dedup, url_filter, winnowing
from activity_engine.llm.components import components

from .conftest import EDGES, prose


# -- op1 ----------------------------------------------------------------------------

def test_urls(spark):
    rows = [(1, None), (2, "nourl"), (3, "http://A.NET"), (4, "HTTP://Ex.Example.NET/en/?q"), (5, "http://a/b?c://d"),
            (6, "x://é.org/fr/ü#"), (7, "http://?x"), (7, "http://?x"), (None, "http://net/"), (8, ""),
            (9, "http://notnet/"), (10, "http://my.net/a"), (11, "h://a.example.net/en/x"), (12, "h://example.com/de/"),
            (13, "h://a.com/" + "y" * 20_000)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, text string")
    got = sorted(((r.page_id, r.host, r.path, r.rule) for r in url_filter.judge_urls(pages).collect()), key=str)
    want = [(1, "", "", None), (2, "", "", None), (3, "a.net", "", None), (4, "ex.example.net", "/en/", "example.net/en/"),
            (5, "a", "/b", None), (6, "é.org", "/fr/ü", "org/fr/"), (7, "", "", None), (7, "", "", None),
            (None, "net", "/", "net/"), (8, "", "", None), (9, "notnet", "/", None), (10, "my.net", "/a", "net/"),
            (11, "a.example.net", "/en/x", "example.net/en/"), (12, "example.com", "/de/", "example.com/de/"),
            (13, "a.com", "/" + "y" * 20_000, None)]
    assert got == sorted(want, key=str)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    unruled = url_filter.judge_urls(pages.filter("page_id in (1, 2)"))
    assert {r.verdict for r in unruled.collect()} == {"allow"}


def test_url_models_separate(spark):
    rnd = random.Random(2)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(12))
    rows = [f"h://{word('abcdef')}.org/fr/{word('abcdef')}" for _ in range(300)]
    rows += [f"h://{word('uvwxyz')}.net/{word('uvwxyz')}" for _ in range(300)]
    rows += [f"h://{word('abcdef')}.io/{word('abcdef')}" for _ in range(50)]
    rows += [f"h://{word('uvwxyz')}.io/{word('uvwxyz')}" for _ in range(50)]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(pages).collect()}
    assert all(got[i] == "allow" for i in range(600, 650)) and all(got[i] == "block" for i in range(650, 700))


def test_urls_match_sql(spark):
    source = "/root/testdata/sf0.01/pages.parquet"
    got = sorted(tuple(r) for r in url_filter.url_digest(spark.read.parquet(source)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{source}'")
    assert got == sorted(con.execute(url_filter.url_sql()).fetchall())


# -- op6 ----------------------------------------------------------------------------

def brute_removal(texts, length):
    seen = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for b in data:
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def brute_passages(texts, words=51):
    """Bytes of each text in runs of ``words`` words that another text, or a copy of it, holds."""
    found = [[(m.start(), m.end(), m[0]) for m in re.finditer(rb"[^ \t-\r]+", (t or "").encode())] for t in texts]
    runs = [[tuple(w[2] for w in own[i:i + words]) for i in range(len(own) - words + 1)] for own in found]
    holders = collections.Counter(r for own in runs for r in set(own))
    out = []
    for own, spans in zip(found, runs):
        inside = set()
        for i, r in enumerate(spans):
            if holders[r] > 1:
                inside.update(range(own[i][0], own[i + words - 1][1]))
        out.append(len(inside))
    return out


def repeated_texts():
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcd efgh") for _ in range(2500))
    texts = ["x" * 399, "x" * 401, "ab" * 500, base[:1000], base[:1000], base[500:1600] + "q" * 50,
             base[700:1101] + "zz", "é" * 900, base[100:400] * 2 + base[900:1500]]
    for _ in range(30):
        at = rnd.randint(0, 2000)
        noise = lambda: "".join(rnd.choice("xyz ") for _ in range(rnd.randint(0, 300)))
        texts.append(noise() + base[at:at + rnd.randint(300, 900)] + noise())
    short = [str(i % 97) for i in range(60)]
    texts += [" ".join(["p", *short[:k], "q"]) for k in (50, 51, 60)] + ["\n ".join(short[5:58])]
    texts += [" ".join(["alone", *[f"r{i}" for i in range(55)]] * 2)]          # repeated by itself only
    return [t for _, t in EDGES if not t or len(t) < 5000] + texts


@pytest.mark.parametrize("options", [{}, {"bucket_stretches": 2}, {"length": 64, "gram": 32}])
def test_removal(spark, options):
    """A small ``bucket_stretches`` sends groups the way of those too large for a task."""
    texts = repeated_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.dedup_digest(docs, **options).collect()}
    assert [got[i][:4] for i in range(len(texts))] == brute_removal(texts, options.get("length", 400))
    assert [got[i][4] for i in range(len(texts))] == brute_passages(texts)
    assert got[len(texts) - 1][4] == 0 and got[len(texts) - 2][4] > 0


def test_removal_edges(edges, no_docs):
    got = suffix_dedup.remove_repeats(edges)            # in place of the column of that name
    assert sorted(got.columns) == sorted(edges.columns) and got.count() == len(EDGES)
    beside = suffix_dedup.remove_repeats(edges, out="cut")
    assert beside.columns == [*edges.columns, "cut"]
    assert {(r["_removal"], r["_found"]) for r in beside.select("_removal", "_found").distinct().collect()} == {("_removal", "_found")}
    assert suffix_dedup.dedup_digest(no_docs).count() == 0


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab", min_size=1, max_size=200) | st.binary(min_size=1, max_size=200).map(lambda b: b.decode("latin-1")))
def test_two_stage_order(text):
    body, length = text.encode("latin-1"), 16
    data = body + b"\0" * length + b"\xff"
    order = suffix_dedup.suffix_order(data, np.arange(len(body)), length).tolist()
    assert sorted(order) == list(range(len(body)))
    keys = [data[i:i + length] for i in order]
    assert keys == sorted(keys)
    shared = suffix_dedup.common_prefix_reaches(data, np.array(order), length)
    assert shared.tolist() == [a == b for a, b in zip(keys, keys[1:])]


# -- op7 ----------------------------------------------------------------------------

def shingle_set(text):
    words = (text or "").encode().lower().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute_groups(texts):
    sets = [shingle_set(t) for t in texts]
    parent, links = list(range(len(sets))), [0] * len(sets)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                links[i] += 1
                links[j] += 1
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return [(root(i), links[i]) for i in range(len(sets))]


def near_copies():
    rnd = random.Random(5)
    texts = [t for _, t in EDGES]
    for copies in (1, 2, 2, 3, 40):
        base = prose(rnd.randrange(10 ** 6), rnd.choice([60, 150])).split()
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randint(0, 2)):
                own[rnd.randrange(len(own))] = f"w{rnd.randrange(400)}"
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("block", [256, 8])
def test_groups(spark, block):
    """Blocks of 8 spread the large group over several pairs of blocks."""
    texts = near_copies()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_groups(docs, block=block).collect()}
    want = brute_groups(texts)
    assert [got[i] for i in range(len(texts))] == want
    kept = sorted(r.doc_id for r in jaccard_join.keep_one(docs, block=block).collect())
    assert kept == sorted({c for c, _ in want})


def test_group_edges(edges, no_docs):
    kept = jaccard_join.keep_one(edges)
    assert kept.columns == edges.columns
    rows = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert rows[5, "one"] == 0 and rows[4, "one"] == 1 and rows[1, None] == 1 and rows[None, "one two"] == 1
    assert rows[6, prose(1, 60)] == 1 and (7, prose(1, 60)) not in rows
    assert jaccard_join.join_digest(no_docs).count() == 0 and jaccard_join.keep_one(no_docs).count() == 0


def test_bands():
    bands, rows = jaccard_join.choose_bands(0.8, 0.9999)
    assert bands * rows <= jaccard_join.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.9999


def test_components(spark):
    rnd = random.Random(4)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(50)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    want = {x: root(x) for x in parent if root(x) != x}
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r.node: r.label for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- op9 ----------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def bench_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        words = bench_words(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1) if n else ():
            windows[tuple(words[i:i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for _, text in docs:
        words = bench_words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((len(words), len(hit), len(found), digest, bool(hit)))
    return out


def test_contamination(spark, no_docs):
    rnd = random.Random(6)
    items = [(i, prose(100 + i, rnd.randint(8, 40), 30)) for i in range(20)]
    items += [(30, items[0][1]), (31, None), (32, ""), (33, "w1 w2"), (34, "É W3-w4"), (35, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    docs = [(i, t) for i, (_, t) in enumerate(EDGES) if not t or len(t) < 20_000]
    for i in range(60):
        words = (items[rnd.randrange(20)][1] or "").split()
        at = rnd.randint(0, max(0, len(words) - 9))
        docs.append((100 + i, " ".join([prose(i, 5, 30), *words[at:at + rnd.randint(8, 14)], prose(i + 99, 5, 30)]).upper()))
    docs += [(300, "w1 " * 30), (301, "x é, w3 W4 y")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in winnowing.contamination_digest(frame, tests).collect()}
    want = brute_contamination(docs, items)
    assert [got[i] for i, _ in docs] == want
    clean = sorted(r.doc_id for r in winnowing.clean_documents(frame, tests).collect())
    assert clean == sorted(i for (i, _), w in zip(docs, want) if not w[4])
    none = winnowing.contamination_digest(frame, tests.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(docs)
    assert winnowing.contamination_digest(no_docs, tests).count() == 0


def test_contamination_edges(spark, edges):
    tests = spark.createDataFrame([(None, "one"), (1, "one two")], "item_id long, text string")
    got = winnowing.clean_documents(edges, tests)
    assert got.columns == edges.columns
    assert got.count() == len(EDGES) - 4


@hypothesis_settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=10, max_size=60), st.integers(0, 50))
def test_every_shared_span_has_a_fingerprint(words, at):
    from activity_engine.llm.common import gram_hashes
    hashes = np.array(words, np.uint64) + np.uint64(1)
    at = min(at, len(words) - 10)
    span = gram_hashes(hashes[at:at + 10], 5)
    whole = gram_hashes(hashes, 5)
    inside = winnowing.fingerprints(span, 10, 5)
    assert len(inside) == 1 and at + inside[0] in winnowing.fingerprints(whole, 10, 5)


def test_removal_stages_no_row_a_run(spark, monkeypatch):
    """What copies share is told by stretches: no staged table has a row for every run of words."""
    staged = {}

    def counted(df, name, write=suffix_dedup.materialize):
        table = write(df, name)
        staged[name] = staged.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(suffix_dedup, "materialize", counted)
    words = [f"w{i * i % 997}-{i}" for i in range(3000)]
    texts = [" ".join(words)] * 2 + [" ".join([*words, "end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    suffix_dedup.dedup_digest(docs).collect()
    assert max(staged.values()) < len(words)


def test_passage_repeated_in_one_text_and_held_in_part_by_another(spark):
    """Every place of a run counts, however its words are spaced, if another document holds it."""
    run = [f"k{i % 89}{i % 7}" for i in range(90)]
    texts = [" ".join(["a1", *run, "a2"] * 2) + "\n" + "  ".join(["a1", *run, "a2"])]
    texts += [" ".join([f"b{k}", *run[k:k + 55], f"c{k}"]) for k in (0, 17, 35)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_passage_bytes for r in suffix_dedup.dedup_digest(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_passages(texts) and got[0] > 3 * 90


@pytest.mark.parametrize("longest", [3, 300_000])
def test_word_and_gram_hashes_do_not_depend_on_their_place(longest):
    rnd = random.Random(longest)
    words = [bytes(rnd.choices(b"abcdefgh\x00\xff", k=rnd.randint(1, longest if i % 50 == 7 else 9))) for i in range(300)]
    text = b" ".join(words)
    begins, ends = suffix_dedup._word_bounds(text)
    assert [text[a:b] for a, b in zip(begins, ends)] == text.split()
    hashes = suffix_dedup._word_hashes(text, begins, ends)
    alone = [suffix_dedup._word_hashes(w, np.array([0]), np.array([len(w)]))[0] for w in words]
    assert hashes.tolist() == alone and len(set(alone)) == len(set(words))
    data = np.frombuffer(text[:400_000] + text[:700], np.uint8)
    grams = suffix_dedup._gram_hashes(data, 256)
    at = min(len(text), 400_000)
    assert len(grams) == len(data) - 255 and grams[:400].tolist() == grams[at:at + 400].tolist()
