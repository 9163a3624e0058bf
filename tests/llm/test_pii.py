"""Operator 11 against a plain version: other expressions, all counts in dictionaries."""

import collections
import hashlib
import math
import random
import re
import time

import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st

from activity_engine.llm import pii

from .conftest import EDGES, prose

FORMS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
WORD = re.compile(r"[^\W_]+")


def passes_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def brute_base(text):
    out = []
    for kind, form in enumerate(FORMS):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == 1 and any(int(p) > 255 for p in m.group().split("."))
                    or kind == 2 and not (14 <= len(digits) <= 19 and passes_luhn(digits))
                    or kind == 3 and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def brute_disclosed(texts):
    """(words and stems that disclose an entity, per text its words outside mentions)."""
    corpus, near, places, outside = collections.Counter(), collections.defaultdict(collections.Counter), collections.defaultdict(set), []
    for text in texts:
        spans = brute_base(text)
        plain = [m.group().lower() for m in WORD.finditer(text)]
        corpus.update(plain)
        corpus.update(w[:4] + "*" for w in plain)
        corpus[""] += len(plain)
        own = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)
               if not any(s < m.end() and e > m.start() for s, _, e in spans)]
        outside.append(own)
        beside = collections.defaultdict(list)
        for s, kind, e in spans:
            value = text[s:e].lower() if kind == 0 else text[s:e] if kind == 1 else re.sub("[^0-9]", "", text[s:e])
            at = sum(w[1] < s for w in own)
            low, high = max(0, at - 12), min(len(own), at + 12)
            held = beside[kind, value]
            if held and low < held[-1][1]:
                held[-1][1] = max(high, held[-1][1])
            else:
                held.append([low, high])
        for name, parts in beside.items():
            for low, high in parts:
                around = tuple(w[0] for w in own[low:high])
                for w in around:
                    for term in (w, w[:4] + "*"):
                        near[name][term] += 1
                        places[name, term].add(around)
    bad = set()
    for name, counts in near.items():
        beside = sum(n for t, n in counts.items() if not t.endswith("*"))
        bad |= {t for t, n in counts.items() if len(places[name, t]) >= 3 and beside < corpus[""]
                and 1 - math.log(min(1, n / corpus[t])) / math.log(beside / corpus[""]) >= pii.THRESHOLD}
    return bad, outside


def brute(rows):
    texts = [t or "" for _, t in rows]
    bad, outside = brute_disclosed(texts)
    names = [*pii.KINDS, pii.TERM]
    out = []
    for (i, _), text, own in zip(rows, texts, outside):
        base = brute_base(text)
        show = lambda spans: ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))
        terms = [(s, 4, e) for w, s, e in own if w in bad]
        out.append((i, *[sum(k == j for _, k, _ in base) for j in range(4)],
                    hashlib.sha256(show(base).encode()).hexdigest(), show(base + terms), len(terms)))
    return out, bad


def corpus():
    """An address whose owner is named beside it, once apart from it, among other texts."""
    rows = [(i, prose(i, 80, 150)) for i in range(40)]
    for i in range(5):
        rows.append((100 + i, f"{prose(200 + i, 40, 150)} Zorblatt wrote from z.blatt@mail.example.com today. {prose(300 + i, 40, 150)}"))
    rows.append((110, f"{prose(400, 30, 150)} again ZORBLATT, who {prose(401, 30, 150)} zorbing"))
    # one text four times: one surroundings, so nothing beside it discloses
    rows += [(120 + i, f"{prose(500, 20, 150)} onceonly 10.0.0.7 {prose(501, 20, 150)}") for i in range(4)]
    rows += [(130 + i, f"call +1 (555) 010-{i:04d} or 4111 1111 1111 1111 {prose(600 + i, 9, 150)} kappa{i % 2}") for i in range(6)]
    return rows + [(i, t) for i, t in EDGES if not t or len(t) < 20_000]


@hypothesis_settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@12+() -%é9256", max_size=40) | st.text(max_size=60)
       | st.from_regex(r"([0-9]{4}[ -]?){4}\+?[0-9 .()]{0,20}[a-z]@[a-z]{2}(\.[a-z@]{1,3}){0,3}", fullmatch=True))
def test_forms(text):
    assert pii.base_spans(text) == brute_base(text)


def test_forms_take_linear_time():
    began = time.time()
    pii.base_spans("x" * 10**6 + " " + "1" * 10**6 + " " + "@" * 10**5 + "a@b" * 10**5 + "+" + "1." * 10**5)
    assert time.time() - began < 20


def test_cards_and_addresses():
    assert pii.base_spans("1.2.3.256 1.2.3.4.5.6.7.8 000255.1.1.1") == [(10, 1, 17), (18, 1, 25), (26, 1, 38)]
    assert [k for _, k, _ in pii.base_spans("4111-1111 1111 1111, 4111 1111 1111 1112")] == [2]


def test_digest_is_the_plain_version(spark):
    rows = corpus()
    want, bad = brute(rows)
    assert "zorblatt" in bad and "onceonly" not in bad
    got = pii.pii_digest(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    by_id = {w[0]: w for w in want}
    assert "term" in by_id[110][6] and "term" not in by_id[120][6]


def test_sanitised_texts(spark):
    docs = spark.createDataFrame([(i, t, "kept", "kept") for i, t in corpus()], "doc_id long, text string, _change string, key string")
    got = pii.sanitise(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == docs.count() and all(r["_change"] == r.key == "kept" for r in rows)
    text = {r.doc_id: r.text for r in rows}
    _, bad = brute(corpus())
    assert "[email]" in text[100] and "example.com" not in text[100] and "Zorblatt" not in text[100]
    assert "ZORBLATT" not in text[110] and ("zorb*" in text[110]) == ("zorb*" not in bad) and text[0] == prose(0, 80, 150)
    assert "[phone]" in text[130] and "[card]" in text[130] and "[ip]" in text[120] and text[1] is None


def test_edges(spark, edges, no_docs):
    got = pii.pii_digest(edges)
    assert got.count() == len(EDGES) and pii.pii_digest(no_docs).count() == 0
    want, _ = brute(EDGES)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("count", [0, 1, 500])
def test_word_table(spark, count):
    words = [f"w{i}" for i in range(count)]
    table = pii.WordTable(spark.createDataFrame([(w,) for w in words], "term string"), "term")
    holds = table.reader()
    assert all(holds[w] for w in words) and sum(holds[f"other{i}"] for i in range(5000)) < 50
