"""Operator 12 against trees built level by level in plain Python, and against its SQL."""

import collections
import hashlib
import zlib

import duckdb
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from activity_engine.llm import merkle_manifest as mm


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def leaf(row, add=0):
    out = ""
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if value is not None and name == "n_chars":
            value += add
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(out)


def steps(tree, i):
    for nodes in tree[:-1]:
        yield (i & 1, nodes[i ^ 1]) if i ^ 1 < len(nodes) else (None, None)
        i //= 2


def brute(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {n: levels([leaf(r) for r in groups[n]]) for n in names}
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for t, n in enumerate(names):
        for i, row in enumerate(groups[n]):
            path = [*steps(trees[n], i), *steps(top, t)]
            tampered = None not in (row["doc_id"], row["n_chars"]) and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            node = leaf(row, 1) if tampered else leaf(row)
            for side, other in path:
                node = h(node) if other is None else h(other, node) if side else h(node, other)
            out.append((row["doc_id"], leaf(row), trees[n][-1][0], top[-1][0], h(*[d for _, d in path if d]), node, node == top[-1][0]))
    return out


@hypothesis_settings(max_examples=60, deadline=None)
@given(st.integers(1, 90), st.integers(0, 3))
def test_positions_are_those_of_the_log(count, extra):
    """Closed-form places equal a log written node by node, open right edges included."""
    digests = [bytes([i]) * 32 for i in range(count)]
    top = mm.height(count) + extra
    log = mm.append_log(digests, top)
    own, seen = digests, []
    for level in range(top + 1):
        for i, node in enumerate(own):
            seen.append(mm.position(level, i, count))
            assert log[seen[-1]] == node
        own = [mm.digest(*own[i:i + 2]) for i in range(0, len(own), 2)]
    assert sorted(seen) == list(range(len(log)))
    root = log[-1]
    for i in range(count):
        assert mm.fold(digests[i], mm.path_in(log, count, top, i)) == root
        assert mm.fold(b"x" * 32, mm.path_in(log, count, top, i)) != root


@pytest.fixture(scope="module")
def many(spark):
    """Trees of 3, 7, 1 and 690 leaves: null, empty, one and another language."""
    return spark.range(701).selectExpr(
        "nullif(id, 700) doc_id", "cast(null as string) source",
        "case when id < 3 then null when id < 10 then '' when id < 11 then 'ü' else 'y' end lang",
        "nullif(id, 20) n_chars", "repeat('é', id % 5) text")


@pytest.mark.parametrize("bits", [2, 3, 9])
def test_proofs(many, bits):
    tamper = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    got = mm.prove(many, tamper, bits).drop("path").collect()
    want = brute([r.asDict() for r in many.collect()])
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert 0 < sum(not r.verified for r in got) < 701


def test_log_of_whole_trees(many):
    """The rounds' nodes, by position, are the log that one builder would write."""
    rounds = mm.build(mm.numbered(mm.leaves(many), ["doc_id", "leaf"]), 2)
    assert len(rounds) > 2
    trees = collections.defaultdict(list)
    for r in mm.log_nodes(rounds, 2).collect():
        trees[r.tree].append(r)
    assert len(trees) == 4
    for nodes in trees.values():
        nodes.sort(key=lambda r: r.position)
        assert [r.position for r in nodes] == list(range(len(nodes)))
        own = [r.node for r in nodes if r.level == 0]
        assert [r.node for r in nodes] == mm.append_log(own, mm.height(len(own)))


def test_edges_and_sql(spark, edges, no_docs):
    assert mm.manifest_digest(no_docs).count() == 0
    rows = [r.asDict() for r in edges.collect()]
    want = sorted(brute(rows), key=str)
    assert sorted(map(tuple, mm.manifest_digest(edges).collect()), key=str) == want
    con = duckdb.connect()
    con.register("documents", edges.toPandas()[["doc_id", "text", "lang", "source", "n_chars"]].astype({"doc_id": "Int64"}))
    con.execute("set threads = 2")
    assert sorted(con.execute(mm.manifest_sql()).fetchall(), key=str) == want
