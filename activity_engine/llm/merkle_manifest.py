"""Merkle manifest of a dataset (operator 12): a postorder append log.

Every row is a leaf; the leaves of one ``tree`` (the language) form a binary tree in
which a last node without a neighbour is hashed alone, and the roots of the trees
form one more tree above them. Builders work on aligned runs of 2^``bits`` leaves: a
builder needs no other, appends its nodes in the order in which they are complete
(a leaf, then every node that this leaf completes; what the right edge leaves open
comes last, from the bottom up), and hands its top node to the next round, whose
leaves are those top nodes. Rounds grow with the logarithm of the largest tree.

Where a node stands in such a log follows from its level and index alone
(``position``): after m leaves the log holds 2m - popcount(m) nodes. Siblings are
addressed that way, so a proof is read from the log without a search.

``build`` writes the log, ``prove`` reads it and gives every leaf its siblings,
``log_nodes`` lists all nodes with their places in the log of their whole tree.

H is the lowercase hex SHA-256 of the texts put one after another. Defined results:
a null field is ``-`` in its leaf; leaves ascend by id, then by digest (null ids
first); repeated rows are leaves of their own; a null tree comes first and differs
from the empty one; a lone leaf is its tree's root; an empty table gives no rows. Of
``docs`` only the five named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activity_engine.llm.common import materialize

#: log2 of the leaves of one aligned run.
RUN_BITS = 9
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: One step of a path: a byte (0: the sibling is left, 1: right, 2: there is none), a digest.
STEP = 33
LEFT, RIGHT, ALONE = 0, 1, 2


def digest(*parts: bytes) -> bytes:
    """H of digests (raw bytes in and out; hashed as hex text)."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    return max(leaves - 1, 0).bit_length()


def position(level: int, index: int, leaves: int) -> int:
    """Place of node (level, index) in the log of a tree of ``leaves`` leaves.

    A full node is written right after its last leaf; one at the open right edge after
    all full nodes, bottom up from the first level that does not divide ``leaves``.
    """
    end = (index + 1) << level
    if end <= leaves:
        return 2 * (end - 1) - (end - 1).bit_count() + level
    return 2 * leaves - leaves.bit_count() + level - (leaves & -leaves).bit_length()


def append_log(leaves: list[bytes], top: int) -> list[bytes]:
    """The nodes of levels 0 to ``top`` over ``leaves`` in completion order."""
    log: list[bytes] = []
    open_nodes: list[list[bytes]] = [[] for _ in range(top + 1)]  # complete, without a parent yet
    for leaf in leaves:
        level, node = 0, leaf
        while True:
            log.append(node)
            open_nodes[level].append(node)
            if level == top or len(open_nodes[level]) < 2:
                break
            node = digest(*open_nodes[level])
            open_nodes[level].clear()
            level += 1
    for level in range(top):
        if open_nodes[level]:
            node = digest(*open_nodes[level])
            open_nodes[level].clear()
            log.append(node)
            open_nodes[level + 1].append(node)
    return log


def path_in(log: list[bytes], leaves: int, top: int, index: int) -> bytes:
    """The steps from leaf ``index`` up to level ``top``, read from ``log``."""
    steps = []
    for level in range(top):
        sibling = index ^ 1
        if sibling << level >= leaves:
            steps.append(bytes([ALONE]) + bytes(STEP - 1))
        else:
            steps.append(bytes([LEFT if index & 1 else RIGHT]) + log[position(level, sibling, leaves)])
        index >>= 1
    return b"".join(steps)


def fold(node: bytes, path: bytes) -> bytes:
    """The root that ``node`` leads to along ``path``."""
    for at in range(0, len(path), STEP):
        side, sibling = path[at], path[at + 1:at + STEP]
        node = digest(node) if side == ALONE else digest(sibling, node) if side == LEFT else digest(node, sibling)
    return node


def siblings_digest(path: bytes) -> str:
    """H of the siblings along ``path``."""
    return hashlib.sha256("".join(path[at + 1:at + STEP].hex() for at in range(0, len(path), STEP)
                                  if path[at] != ALONE).encode()).hexdigest()


def leaf_text(fields: dict[str, Column]) -> Column:
    """What a leaf hashes: per field ``-`` if null, else its bytes' number, a colon, the value."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat(*[part(c) for c in fields.values()])


def leaves(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """(tree, doc_id, leaf, tampered) of every row; ``tampered`` is null where ``tamper`` is not true."""
    fields = {c: F.col(c) for c in FIELDS}
    changed = fields | {"n_chars": F.col("n_chars") + 1}
    hashed = lambda f: F.unhex(F.sha2(leaf_text(f), 256))
    other = F.lit(None).cast("binary") if tamper is None else F.when(tamper, hashed(changed))
    # Null and the empty language are different trees, and null comes first.
    return docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
                       F.col("doc_id").cast("long").alias("doc_id"), hashed(fields).alias("leaf"), other.alias("tampered"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``i``, the place of each row in its tree by ``order``, and ``n``, the tree's rows.

    A range shuffle and a sort; places are counted inside each range, and the ranges
    before add up to its offset, so no task sees a whole tree.
    """
    by = ["tree", *order, "_row"]
    ranged = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    kept = materialize(ranged.drop("_row").select("*", F.spark_partition_id().alias("_part"),
                                                  F.monotonically_increasing_id().alias("_at")), "sorted")
    parts = kept.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "_part", "_first", F.sum("_rows").over(tree).alias("n"),
                         F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return (kept.join(parts, ["tree", "_part"])
            .select(*df.columns, "n", (F.col("_at") - F.col("_first") + F.col("_before")).alias("i")))


BLOCK = ("tree string, run long, n long, doc_ids array<long>, tampered array<binary>,"
         " nodes array<binary>, top binary")


def _top(n: int, bits: int) -> int:
    """Levels a run is raised: all of them if it is its tree's only one."""
    return bits if n > 1 << bits else height(n)


def _build_runs(bits: int):
    def run(batches):
        for batch in batches:
            nodes, tops = [], []
            for n, own in zip(batch.column("n").to_pylist(), batch.column("digests").to_pylist()):
                log = append_log(own, _top(n, bits))
                nodes.append(log)
                tops.append(log[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("run"), batch.column("n"), batch.column("doc_ids"),
                 batch.column("tampered"), pa.array(nodes, pa.list_(pa.binary())), pa.array(tops, pa.binary())],
                ["tree", "run", "n", "doc_ids", "tampered", "nodes", "top"])
    return run


def _round(rows: DataFrame, bits: int, name: str) -> DataFrame:
    """One round's part of the log: a row a run, from (tree, n, i, doc_id, leaf, tampered)."""
    inside = F.sort_array(F.collect_list(F.struct("i", "doc_id", "leaf", "tampered")))
    runs = (rows.groupBy("tree", F.shiftright("i", bits).alias("run"))
            .agg(F.first("n").alias("n"), inside.alias("_in"))
            .select("tree", "run", "n", F.col("_in.doc_id").alias("doc_ids"),
                    F.col("_in.tampered").alias("tampered"), F.col("_in.leaf").alias("digests")))
    return materialize(runs.mapInArrow(_build_runs(bits), BLOCK), name)


def build(rows: DataFrame, bits: int = RUN_BITS) -> list[DataFrame]:
    """The log of all trees over numbered leaves, one DataFrame a round; the last has one run a tree."""
    rounds = [_round(rows, bits, "log")]
    largest = rounds[0].agg(F.max("n")).first()[0] or 0
    while largest > 1 << bits:
        size = (1 << bits) - 1
        top = rounds[-1].select(
            "tree", F.shiftright(F.col("n") + size, bits).alias("n"), F.col("run").alias("i"),
            F.lit(None).cast("long").alias("doc_id"), F.col("top").alias("leaf"),
            F.lit(None).cast("binary").alias("tampered"))
        rounds.append(_round(top, bits, "log"))
        largest = (largest + size) >> bits
    return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, leaf): the root of every tree."""
    return rounds[-1].select("tree", F.col("top").alias("leaf"))


def _read_paths(bits: int):
    """Per run of a lower round: the paths of its leaves, ending in the path of its run."""
    def run(batches):
        for batch in batches:
            out = {"tree": [], "i": [], "path": []}
            cols = [batch.column(c).to_pylist() for c in ("tree", "run", "n", "nodes", "doc_ids", "path")]
            for tree, number, n, nodes, ids, above in zip(*cols):
                for k in range(len(ids)):
                    out["tree"].append(tree)
                    out["i"].append((number << bits) + k)
                    out["path"].append(path_in(nodes, len(ids), _top(n, bits), k) + above)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["tree"], pa.string()), pa.array(out["i"], pa.int64()), pa.array(out["path"], pa.binary())],
                ["tree", "i", "path"])
    return run


def _climb(rounds: list[DataFrame], above: DataFrame, bits: int) -> DataFrame:
    """(tree, run, path) for the first round's runs, from (tree, path) of the trees' roots."""
    paths = above.select("tree", F.lit(0).cast("long").alias("run"), "path")
    for blocks in reversed(rounds[1:]):
        paths = (blocks.join(paths, ["tree", "run"])
                 .mapInArrow(_read_paths(bits), "tree string, i long, path binary")
                 .withColumnRenamed("i", "run"))
    return paths


PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string,"
          " folded_root string, verified boolean, path binary")


def _prove_runs(bits: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
        ("verified", pa.bool_()), ("path", pa.binary())])

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in
                    ("n", "nodes", "doc_ids", "tampered", "path", "subroot", "root")]
            for n, nodes, ids, tampered, above, subroot, root in zip(*cols):
                out = {c: [] for c in schema.names}
                for k, (doc_id, other) in enumerate(zip(ids, tampered)):
                    leaf = nodes[position(0, k, len(ids))]
                    path = path_in(nodes, len(ids), _top(n, bits), k) + above
                    folded = fold(leaf if other is None else other, path)
                    for name, value in zip(out, (doc_id, leaf.hex(), subroot.hex(), root.hex(),
                                                 siblings_digest(path), folded.hex(), folded == root, path)):
                        out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=schema)
    return run


def prove(docs: DataFrame, tamper: Column | None = None, bits: int = RUN_BITS) -> DataFrame:
    """Every row's leaf, roots, proof, and the root its (``tamper``: changed) leaf folds to.

    ``path`` holds the steps of the proof: a byte for the side and the sibling's digest.
    """
    rounds = build(numbered(leaves(docs, tamper), ["doc_id", "leaf"]), bits)
    # The tree of the trees: its leaves are their roots, in the order of their names.
    subroots = materialize(roots(rounds).select(
        F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("leaf")), "subroots")
    order = numbered(subroots, ["name"])
    forest = build(order.select("tree", "n", "i", F.lit(None).cast("long").alias("doc_id"), "leaf",
                                F.lit(None).cast("binary").alias("tampered")), bits)
    root = roots(forest).select("leaf")
    top = _climb(forest, forest[-1].select("tree", F.lit(b"").alias("path")), bits)
    above = (forest[0].join(top, ["tree", "run"])
             .mapInArrow(_read_paths(bits), "tree string, i long, path binary")
             .join(order.select("i", "name", "leaf"), "i")
             .select(F.col("name").alias("tree"), "path", F.col("leaf").alias("subroot"), root.scalar().alias("root")))
    above = materialize(above, "above")
    paths = _climb(rounds, above, bits)
    return (rounds[0].join(paths, ["tree", "run"]).join(above.select("tree", "subroot", "root"), "tree")
            .select("n", "nodes", "doc_ids", "tampered", "path", "subroot", "root")
            .mapInArrow(_prove_runs(bits), PROOFS))


def _list_nodes(bits: int, base: int):
    schema = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("index", pa.int64()),
                        ("position", pa.int64()), ("node", pa.binary())])

    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("tree", "run", "n", "nodes", "doc_ids", "leaves")]
            for tree, number, n, nodes, ids, total in zip(*cols):
                out = {c: [] for c in schema.names}
                # A later round's leaves are the nodes its runs hand on: the round before lists them.
                for level in range(min(base, 1), _top(n, bits) + 1):
                    for i in range(max(1, (len(ids) + (1 << level) - 1) >> level)):
                        index = (number << bits - level) + i
                        for name, value in zip(out, (tree, base + level, index, position(base + level, index, total),
                                                     nodes[position(level, i, len(ids))])):
                            out[name].append(value)
                yield pa.RecordBatch.from_pydict(out, schema=schema)
    return run


def log_nodes(rounds: list[DataFrame], bits: int = RUN_BITS) -> DataFrame:
    """(tree, level, index, position, node) of all nodes; ``position`` is that in the tree's log."""
    sizes = rounds[0].where(F.col("run") == 0).select("tree", F.col("n").alias("leaves"))
    listed = [blocks.join(sizes, "tree").mapInArrow(
        _list_nodes(bits, number * bits), "tree string, level int, index long, position long, node binary")
        for number, blocks in enumerate(rounds)]
    out = listed[0]
    for more in listed[1:]:
        out = out.unionByName(more)
    return out


def manifest_digest(docs: DataFrame) -> DataFrame:
    """The columns of query ``op12_merkle_manifest``."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return prove(docs, (crc % 7 == 0) & F.col("n_chars").isNotNull()).drop("path")


def manifest_sql() -> str:
    """DuckDB SQL of ``op12_merkle_manifest``: level by level over the whole table."""
    def leaf(chars: str) -> str:
        part = "coalesce(octet_length(encode({0}))::varchar || ':' || {0}, '-')"
        return "sha256(" + " || ".join(part.format(c) for c in (
            "doc_id::varchar", "source", "lang", f"({chars})::varchar", "text")) + ")"

    levels = """{0}(tree, level, i, n, h) as (
      select tree, 0::bigint, i, n, h from {1}
      union all
      select tree, any_value(level) + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by i))
      from {0} where n > 1 group by tree, i // 2)"""
    fold = """{0}(r, tree, level, i, h) as (
      select r, tree, 0::bigint, i, h from {1}
      union all
      select f.r, f.tree, f.level + 1, f.i // 2,
             sha256(case when f.i % 2 = 1 then s.h || f.h else f.h || coalesce(s.h, '') end)
      from {0} f join {2} own on own.tree = f.tree and own.level = f.level and own.i = f.i and own.n > 1
      left join {2} s on s.tree = f.tree and s.level = f.level and s.i = xor(f.i, 1))"""
    siblings = """{0} as (
      select l.{3} as id, string_agg(s.h, '' order by s.level) as hs
      from {1} l join {2} s on s.tree = l.tree and s.n > 1 and s.i = xor(l.i // (2 ** s.level)::bigint, 1)
      group by l.{3})"""
    return f"""
    with recursive crc_table as (
      select list(c order by i) as t from (
        select i, list_reduce(list_prepend(i, range(8)),
               lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
        from range(256) b(i))),
    source_rows as (
      select row_number() over () as r, coalesce('=' || lang, '') as tree, doc_id,
             {leaf("n_chars")} as h, {leaf("n_chars + 1")} as changed,
             coalesce(n_chars is not null and doc_id is not null and xor(list_reduce(
               list_prepend(4294967295, list_transform(range(1, length(doc_id::varchar) + 1), lambda k: ascii(substr(doc_id::varchar, k, 1))::bigint)),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0, false) as tampered
      from documents, crc_table),
    leaves as (
      select *, row_number() over (partition by tree order by doc_id nulls first, h, r) - 1 as i,
             count(*) over (partition by tree) as n
      from source_rows),
    {levels.format("nodes", "leaves")},
    tops as (
      select '' as tree, tree as name, h, row_number() over (order by encode(tree)) - 1 as i, count(*) over () as n
      from nodes where n = 1),
    {levels.format("forest", "tops")},
    top as (select h as root from forest where n = 1),
    {siblings.format("inner_siblings", "leaves", "nodes", "r")},
    {siblings.format("outer_siblings", "tops", "forest", "name")},
    changed_leaves as (select r, tree, i, case when tampered then changed else h end as h from leaves),
    {fold.format("folds", "changed_leaves", "nodes")},
    folded_tops as (
      select f.r, '' as tree, t.i, f.h from folds f join nodes n on n.tree = f.tree and n.level = f.level and n.n = 1
      join tops t on t.name = f.tree),
    {fold.format("outer_folds", "folded_tops", "forest")}
    select l.doc_id, l.h as leaf, t.h as subroot, root,
           sha256(coalesce(a.hs, '') || coalesce(b.hs, '')) as proof_sha256,
           o.h as folded_root, o.h = root as verified
    from leaves l join tops t on t.name = l.tree, top
    left join inner_siblings a on a.id = l.r left join outer_siblings b on b.id = l.tree
    join outer_folds o on o.r = l.r
    join forest z on z.level = o.level and z.i = o.i and z.n = 1
    """
