"""Embedding whitening from bit-sliced cross-products (operator 13).

Every entry c becomes the integer floor(64 c) + 1,000,000. For a block of rows each
dimension is shifted by its least value; the bits of one weight, of all rows, are packed
into 64-bit words (a bit plane). The sum of the products of two dimensions is then the
sum over pairs of planes of 2^(p+q) times the number of ones that both planes share: an
AND and a popcount a word, exact whatever the rows. Shifts are taken out again in whole
numbers, blocks and tasks add up in whole numbers, and n * sum(xy) - sum(x) * sum(y) is
centred before the first rounding, so that ``eigh`` sees the covariance to double
precision.

The fit takes each distinct vector once (a shuffle on the vector, combined map-side);
what reaches the driver is d(d+1)/2 sums in 30-bit limbs, whatever the rows. All rows
are then projected on up to 16 components.

Defined results: null vectors and those with null, NaN or infinite entries are dropped;
64 c is held within +-2^60, so that x stays a long; vectors that do not have the
commonest length (of equally common ones the longest) are dropped, as are empty ones;
repeated rows each get their result and count once in the fit; equal eigenvalues keep
the order ``eigh`` gives them. A component of no variance (below 1e-12 of the largest)
has no whitened value: null; it does not count in ``identity_error``, which is null if
no component has variance. ``deviation`` beyond a long is null. Of the table only the id
and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows of a block: the planes of one block are in memory at a time.
BLOCK = 16_384
#: Bits of a limb: sums of limbs stay far inside a long for any number of tasks.
LIMB = 30
BOUND = float(1 << 60)
LONG = (1 << 63) - 1


def fixed_point(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of the rows that have only finite entries and the commonest length."""
    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))

    v = F.col(vector_col)
    as_long = lambda c: F.floor(F.greatest(F.lit(-BOUND), F.least(F.lit(BOUND), c.cast("double") * SCALE))) + OFFSET
    good = vectors.where(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: finite(c.cast("double"))))
    sizes = good.groupBy(F.size(v).alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    size = sizes.agg(F.max(F.struct("rows", "size")).alias("m")).select("m.size").scalar()
    return good.where(F.size(v) == size).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(v, as_long).alias("x"))


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes (words a row), and each plane's dimension and bit, of non-negative values.

    ``shifted`` has one row a dimension. Dimensions have as many planes as they need.
    """
    rows = shifted.shape[1]
    width = -(-rows // 64) * 8
    planes, dims, bits = [], [], []
    for d, values in enumerate(shifted):
        for bit in range(int(values.max()).bit_length()):
            packed = np.packbits((values >> np.uint64(bit)).astype(np.uint8) & 1)
            planes.append(np.concatenate([packed, np.zeros(width - len(packed), np.uint8)]))
            dims.append(d)
            bits.append(bit)
    words = np.concatenate(planes).view(np.uint64).reshape(len(planes), -1) if planes else np.empty((0, 0), np.uint64)
    return words, np.array(dims, np.int64), np.array(bits, np.int64)


def block_moments(x: np.ndarray) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and cross-products (whole numbers of any size) of int64 rows ``x``."""
    n, d = x.shape
    least = x.min(axis=0)
    shifted = np.ascontiguousarray((x.astype(np.uint64) - least.astype(np.uint64)).T)
    words, dims, bits = bit_planes(shifted)
    wide = int(bits.max()) + 1 if len(bits) else 0
    # Both fit: a block's counts times weights in longs, or in Python's numbers.
    kind = np.int64 if 2 * wide + n.bit_length() < 62 else object
    cross = np.zeros((d, d), kind)
    sums = np.zeros(d, kind)
    weights = np.array([1 << int(b) for b in bits], dtype=kind)
    for i in range(len(words)):
        ones = np.bitwise_count(words[i] & words[i:]).sum(axis=1, dtype=np.int64).astype(kind)
        # Pairs of one plane count once, of two planes of one dimension in both orders.
        row = ones * weights[i:] * weights[i]
        part = np.zeros(d, kind)
        np.add.at(part, dims[i:], row)
        own = dims[i]
        part[own] = 2 * part[own] - row[0]
        cross[own] += part
        sums[own] += weights[i] * int(ones[0])
    cross = cross.astype(object)
    upper = np.triu(cross, 1)
    cross = upper + upper.T + np.diag(np.diag(cross))
    shift, total = [int(v) for v in least], [int(v) for v in sums]
    s, t = np.array(shift, dtype=object), np.array(total, dtype=object)
    cross = cross + np.outer(s, t) + np.outer(t, s) + n * np.outer(s, s)
    return n, [a + n * b for a, b in zip(total, shift)], cross


def _limbs(value: int) -> list[int]:
    """``value`` in limbs of base 2^30, the last one signed."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*out, value]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.int64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _task_moments(batches):
    """One task's moments as (a, b, limb, value): -1, -1 the count, a, -1 the sums, a <= b the products."""
    total = None

    def add(block):
        nonlocal total
        own = block_moments(block)
        total = own if total is None else (
            total[0] + own[0], [p + q for p, q in zip(total[1], own[1])], total[2] + own[2])

    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(_matrix(batch.column("x")))
            rows += batch.num_rows
        if rows >= BLOCK:
            add(np.concatenate(held))
            held, rows = [], 0
    if rows:
        add(np.concatenate(held))
    out = []
    if total is not None:
        n, sums, cross = total
        cells = [(-1, -1, n), *[(a, -1, v) for a, v in enumerate(sums)],
                 *[(a, b, cross[a, b]) for a in range(len(sums)) for b in range(a, len(sums))]]
        out = [(a, b, k, limb) for a, b, value in cells for k, limb in enumerate(_limbs(int(value)))]
    columns = list(zip(*out)) or [[], [], [], []]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                                      pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
                                     ["a", "b", "limb", "value"])


def moments(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Count, sums and cross-products of column ``x``, exact. (0, [], empty) without rows."""
    parts = fit.mapInArrow(_task_moments, "a int, b int, limb int, value long")
    n, sums, cells = 0, {}, {}
    for r in parts.groupBy("a", "b", "limb").agg(F.sum("value").alias("value")).collect():  # d(d+3)/2 + 1 sums
        value = r.value << LIMB * r.limb
        if r.a < 0:
            n += value
        elif r.b < 0:
            sums[r.a] = sums.get(r.a, 0) + value
        else:
            cells[r.a, r.b] = cells.get((r.a, r.b), 0) + value
    d = len(sums)
    cross = np.array([[cells[min(a, b), max(a, b)] for b in range(d)] for a in range(d)], dtype=object).reshape(d, d)
    return n, [sums[a] for a in range(d)], cross


class Whitening:
    """Components of the covariance (n * cross - sums * sums) / n^2, the whole part exact."""

    def __init__(self, n: int, sums: list[int], cross: np.ndarray, components: int = COMPONENTS):
        self.n, self.sums = n, sums
        s = np.array(sums, dtype=object)
        centred = n * cross - np.outer(s, s)
        # A whole number over n^2, rounded once; Python divides whole numbers correctly rounded.
        self.covariance = np.array([[int(v) / (n * n) for v in row] for row in centred], dtype=float).reshape(len(s), len(s))
        values, vectors = np.linalg.eigh(self.covariance)
        order = np.argsort(-values, kind="stable")[:components]
        self.values, self.vectors = values[order], vectors[:, order]
        trace = float(np.trace(self.covariance))
        self.varies = self.values > 1e-12 * max(self.values[0], 0) if len(self.values) else np.empty(0, bool)
        self.explained = self.values / trace if trace > 0 else np.zeros(len(self.values))
        self.explained = np.where(self.varies, self.explained, 0.0)
        self.scales = np.sqrt(np.where(self.varies, self.values, 1.0))
        white = (self.vectors / self.scales)[:, self.varies]
        left = white.T @ self.covariance @ white - np.eye(white.shape[1])
        self.identity_error = float(np.abs(left).max()) if left.size else None

    def project(self, x: np.ndarray) -> tuple[list, np.ndarray]:
        """Deviations (exact, null beyond a long) and whitened values (rows by components) of int64 rows."""
        n, d = self.n, len(self.sums)
        spread = max((max(abs(n * int(lo) - s), abs(n * int(hi) - s))
                      for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), self.sums)), default=0)
        widest = max((abs(n * int(v)) for v in (x.min(), x.max())), default=0) + max(map(abs, self.sums))
        if widest <= LONG and spread <= isqrt(LONG // d):
            centred = n * x - np.array(self.sums, np.int64)
            deviation = (centred * centred).sum(axis=1).tolist()
        else:
            centred = n * x.astype(object) - np.array(self.sums, dtype=object)
            deviation = [v if v <= LONG else None for v in (centred * centred).sum(axis=1).tolist()]
        return deviation, (centred.astype(float) / n) @ (self.vectors / self.scales)


OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double,"
       " identity_error double")


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """The columns of query ``op13_embedding_whitening``: a row a vector and component."""
    rows = fixed_point(vectors, id_col, vector_col)
    n, sums, cross = moments(rows.select("x").distinct())
    if not n:
        return rows.sparkSession.createDataFrame([], OUT)
    model = Whitening(n, sums, cross, components)

    def project(batches):
        c = len(model.values)
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            deviation, white = model.project(_matrix(batch.column("x")))
            spread = np.repeat(np.arange(m), c)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(spread)),
                pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)),
                pa.array(np.full(m * c, model.n)),
                pa.array(deviation, pa.int64()).take(pa.array(spread)),
                pa.array(white.ravel(), mask=np.tile(~model.varies, m)),
                pa.array(np.tile(model.explained, m)),
                pa.array([model.identity_error] * (m * c), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, OUT)
