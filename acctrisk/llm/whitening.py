"""Whitening of embeddings on exact cross-products, counted in bit slices.

1. Vectors become whole numbers, and each distinct vector counts once: the fit list.
2. Every block of the fit list is shifted to start at zero in each dimension and cut into bit
   planes; a plane holds one bit of one dimension, packed over the rows into words. The rows in
   which two planes both have a bit are counted by AND and popcount, and these counts, weighted by
   the powers of two of their planes and shifted back, are the block's exact cross-products.
3. Spark adds the blocks up, the driver gets the sums of the dimensions and their pairs. They are
   centred as whole numbers, n * G - S * S', before the division and the eigenvectors.
4. A pass over the fit list measures how far the covariance of the whitened rows is from the
   identity, and one over all rows writes them out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Context, Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise

SCALE = 256
COMPONENTS = 4
# Rows of the fit list that are cut into bit planes together.
BLOCK = 1 << 13
# Sums travel as two numbers, high * 2^LIMB + low.
LIMB = 64
_WIDTHS = (1, 2, 4, 8)
_LONG = 1 << 63


# --- Vectors as whole numbers -------------------------------------------------------------------

def whole_vectors(batch: pa.RecordBatch, column: str, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable rows of a batch and their vectors, floor(scale * entry)."""
    values = batch.column(column)
    if pa.types.is_fixed_size_list(values.type):
        values = values.cast(pa.list_(values.type.value_type))
    flat = pc.list_flatten(values).cast(pa.float64()).fill_null(np.nan).to_numpy(
        zero_copy_only=False)
    lengths = pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False)
    row_of = np.repeat(np.arange(len(lengths)), lengths)
    usable = lengths > 0
    usable[row_of[~np.isfinite(flat)]] = False
    sizes = np.unique(lengths[usable])
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()[:5]}")
    if not len(sizes):
        return np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
    with np.errstate(over="ignore"):
        x = np.floor(scale * flat[usable[row_of]].reshape(-1, sizes[0]))
    if x.size and not (x.min() >= -_LONG and x.max() < _LONG):
        raise ValueError(f"an entry times {scale} leaves 64 bits")
    return np.flatnonzero(usable), x.astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each vector as its width and its entries in that many bytes; equal for equal vectors."""
    top = np.maximum(x.max(1), ~x.min(1))
    width = np.searchsorted([(1 << (8 * w - 1)) - 1 for w in _WIDTHS], top)
    out: list[bytes] = [b""] * len(x)
    for k in np.unique(width):
        rows = np.flatnonzero(width == k)
        size = x.shape[1] * _WIDTHS[k]
        raw = x[rows].astype(f"<i{_WIDTHS[k]}").tobytes()
        for i, row in enumerate(rows.tolist()):
            out[row] = bytes([_WIDTHS[k]]) + raw[i * size:(i + 1) * size]
    return out


def unpacked(blobs: list[bytes]) -> np.ndarray:
    dims = (len(blobs[0]) - 1) // blobs[0][0]
    if any((len(b) - 1) // b[0] != dims for b in blobs):
        raise ValueError("vectors of different lengths")
    return np.array([np.frombuffer(b, dtype=f"<i{b[0]}", offset=1) for b in blobs], dtype=np.int64)


def fit_list(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Every distinct whole-number vector once, packed, as column x; copies fold before they travel."""
    def run(batches):
        for batch in batches:
            rows, x = whole_vectors(batch, column, scale)
            if len(rows):
                yield pa.RecordBatch.from_arrays([pa.array(packed(x), pa.binary())], names=["x"])

    return vectors.select(column).mapInArrow(run, "x binary").distinct()


# --- Bit-sliced cross-products ------------------------------------------------------------------

def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bit planes of rows that are not negative: words, and each plane's dimension and bit.

    A dimension has as many planes as its largest entry has bits.
    """
    bits = [int(top).bit_length() for top in y.max(0)]
    of = np.repeat(np.arange(len(bits)), bits)
    bit = np.concatenate([np.arange(n) for n in bits]) if len(of) else np.zeros(0, np.int64)
    words = -(-len(y) // 64)
    planes = np.zeros((len(of), words * 8), dtype=np.uint8)
    for p, (i, b) in enumerate(zip(of.tolist(), bit.tolist(), strict=True)):
        some = np.packbits((y[:, i] >> np.uint64(b)) & np.uint64(1) != 0, bitorder="little")
        planes[p, :len(some)] = some
    return planes.view(np.uint64), of, bit


def cross_products(x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sums of a block's dimensions and of the products of all pairs, as Python integers."""
    rows, dims = x.shape
    low = x.min(0)
    y = x.view(np.uint64) - low.view(np.uint64)  # exact for any two 64-bit numbers
    planes, of, bit = bit_planes(y)
    counts = np.zeros((len(planes), len(planes)), dtype=np.int64)
    for p in range(len(planes)):
        both = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
        counts[p, p:] = counts[p:, p] = both
    # the counts of equal weight first, then the weights: whatever the bits, nothing overflows
    gram, sums = np.zeros((dims, dims), dtype=object), np.zeros(dims, dtype=object)
    np.add.at(sums, of, np.array([int(c) << int(b) for c, b in zip(np.diag(counts), bit)] or [],
                                 dtype=object))
    weight = bit[:, None] + bit[None, :]
    place = of[:, None] * dims + of[None, :]
    for w in range(int(weight.max()) + 1 if len(planes) else 0):
        some = weight == w
        total = np.bincount(place[some], counts[some], dims * dims)  # below 2^53, exact
        gram += total.astype(np.int64).astype(object).reshape(dims, dims) * (1 << w)
    shift = low.astype(object)
    gram = gram + np.outer(shift, sums) + np.outer(sums, shift) + rows * np.outer(shift, shift)
    return list(sums + rows * shift), gram


SUMS = "i int, k int, high decimal(38,0), low decimal(38,0)"
_CONTEXT = Context(prec=60)


def limbs(value: int) -> tuple[Decimal, Decimal]:
    high, low = value >> LIMB, value & ((1 << LIMB) - 1)
    return _CONTEXT.create_decimal(high), _CONTEXT.create_decimal(low)


def scatter(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S and the cross-products G of the fit list, exact.

    Each task adds up its own blocks, Spark the tasks; the driver gets a row per pair of
    dimensions.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, gram = 0, None, None
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                x = unpacked(batch.column("x").slice(at, BLOCK).to_pylist())
                s, g = cross_products(x)
                if gram is not None and len(s) != len(sums):
                    raise ValueError("vectors of different lengths")
                sums = s if sums is None else [a + b for a, b in zip(sums, s, strict=True)]
                gram = g if gram is None else gram + g
                n += len(x)
        if n:
            found = [(-1, -1, n), *((-1, k, v) for k, v in enumerate(sums))]
            found += [(i, k, gram[i, k]) for i in range(len(sums)) for k in range(i + 1)]
            high, low = zip(*(limbs(int(v)) for _, _, v in found), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _, _ in found], pa.int32()),
                 pa.array([k for _, k, _ in found], pa.int32()),
                 pa.array(high, pa.decimal128(38, 0)), pa.array(low, pa.decimal128(38, 0))],
                names=["i", "k", "high", "low"])

    rows = fit.mapInArrow(run, SUMS).groupBy("i", "k").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    found = {(r.i, r.k): (int(r.high) << LIMB) + int(r.low) for r in rows}
    n = found.pop((-1, -1), 0)
    dims = sum(i == -1 for i, _ in found)
    if any(i >= dims for i, _ in found):
        raise ValueError("vectors of different lengths")
    gram = np.zeros((dims, dims), dtype=object)
    for i in range(dims):
        for k in range(i + 1):
            gram[i, k] = gram[k, i] = found[i, k]
    return n, [found[-1, k] for k in range(dims)], gram


# --- Components ---------------------------------------------------------------------------------

def jacobi(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors by plane rotations, from vectors that nearly are.

    Small eigenvalues come out as precise as large ones where the matrix owes its range to the
    scales of its dimensions.
    """
    a, v = matrix.copy(), vectors.copy()
    dims = len(a)
    for _ in range(30):
        turned = False
        for p in range(dims - 1):
            for q in range(p + 1, dims):
                if abs(a[p, q]) <= 1e-16 * np.sqrt(abs(a[p, p] * a[q, q])):
                    continue
                turned = True
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                s = t * c
                app, aqq, apq = a[p, p], a[q, q], a[p, q]
                for m in (a.T, v.T):  # columns p and q
                    x, y = m[p].copy(), m[q].copy()
                    m[p], m[q] = c * x - s * y, s * x + c * y
                a[p], a[q] = a[:, p], a[:, q]
                a[p, p], a[q, q] = app - t * apq, aqq + t * apq
                a[p, q] = a[q, p] = 0.0
        if not turned:
            break
    return np.diag(a).copy(), v


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: the fit list's size and sums, and the components by falling variance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def reach(self, x: np.ndarray) -> int:
        """No x less the whole part of a mean is larger than this."""
        return max(abs(s) // self.n for s in self.sums) + 1 + max(int(x.max()), -int(x.min()))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n; the whole part of the mean is taken off as a whole number."""
        kind = np.int64 if self.reach(x) < _LONG else object
        whole = np.array([s // self.n for s in self.sums], dtype=kind)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x.astype(kind) - whole).astype(float) - rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum of (n x - S)^2 of each row, exact.

        With x = y + q and S = n q + r it is n^2 y.y - 2 n r.y + r.r, where y and r are small.
        """
        top = max(self.reach(x), self.n)
        kind = np.int64 if top * top * len(self.sums) < _LONG else object
        whole, rest = (np.array(z, dtype=kind) for z in zip(
            *(divmod(s, self.n) for s in self.sums), strict=True))
        y = x.astype(kind) - whole
        rr = sum(int(v) ** 2 for v in rest)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + rr
                for a, b in zip((y * y).sum(1), (y * rest).sum(1), strict=True)]


def components(n: int, sums: list[int], gram: np.ndarray, wanted: int) -> Whitening:
    """The first components of the covariance; dimensions without variance give none."""
    dims = len(sums)
    if not n:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    centred = n * gram - np.outer(np.array(sums, dtype=object), np.array(sums, dtype=object))
    # quotients of whole numbers are rounded once
    cov = np.array([[int(v) / (n * n) for v in row] for row in centred])
    spread = np.sqrt(np.diag(cov))
    some = spread > 0
    scaled = cov[np.ix_(some, some)] / np.outer(spread[some], spread[some])
    rank = int((np.linalg.eigvalsh(scaled) > 1e-13 * max(dims, 8)).sum()) if some.any() else 0
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:min(rank, wanted)]
    if len(order) and values[order[-1]] < 1e-9 * values.max():
        values, vectors = jacobi(cov, np.eye(dims))
        order = np.argsort(-values, kind="stable")[:min(rank, wanted)]
    return Whitening(n, tuple(sums), values[order], vectors[:, order], float(np.trace(cov)))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened fit list less the identity."""
    size = len(model.values)

    def run(batches):
        total, mean = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            if len(batch):
                w = model.whitened(unpacked(batch.column("x").to_pylist()))
                total, mean = total + w.T @ w, mean + w.sum(0)
        names = ["k", "value"]
        flat = np.concatenate([total.ravel(), mean])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)], names=names)

    if not size:
        return 0.0
    rows = fit.mapInArrow(run, "k int, value double").groupBy("k").agg(
        F.sum("value").alias("value")).collect()
    flat = np.zeros(size * size + size)
    for r in rows:
        flat[r.k] = r.value / model.n
    mean = flat[size * size:]
    cov = flat[:size * size].reshape(size, size) - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(size)).max())


WHITENED = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
            "explained double, identity_error double")


def whiten(vectors: DataFrame, column: str = "embedding", scale: int = SCALE,
           wanted: int = COMPONENTS) -> DataFrame:
    """The first `wanted` whitened components of every vector, one row each.

    vectors: vec_id and the vector column; other columns are ignored. Result: vec_id, component
    (from 1), n (distinct vectors), deviation (sum of (n x - S)^2 over the dimensions, exact; null
    beyond 38 digits), whitened, explained (the component's share of the variance) and
    identity_error.

    Rows with a null or empty vector, or a null or non-finite entry, are left out; rows with a
    null vec_id, and repeated rows, are whitened like any other. Components are those with
    variance: a constant dimension, or a single distinct vector, adds none, so there may be
    fewer than `wanted`, or no rows at all. No rows give no rows. Vectors of different lengths and
    entries whose multiple leaves 64 bits stop the query with a ValueError.

    A task holds one block and the sums of the pairs of dimensions, the driver only those sums.
    """
    fit = materialise(fit_list(vectors, column, scale))
    model = components(*scatter(fit), wanted)
    error = identity_error(fit, model)
    size = len(model.values)
    largest = 10 ** 38

    def run(batches):
        for batch in batches:
            rows, x = whole_vectors(batch, column, scale)
            if not len(rows) or not size:
                continue
            deviation = [Decimal(v) if v < largest else None for v in model.deviations(x)]
            ids = batch.column("vec_id").take(pa.array(rows)).cast(pa.int64())
            each = np.repeat(np.arange(len(rows)), size)
            count = len(each)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(each)),
                 pa.array(np.tile(np.arange(1, size + 1), len(rows)), pa.int32()),
                 pa.array(np.full(count, model.n), pa.int64()),
                 pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)),
                 pa.array(model.whitened(x).ravel()),
                 pa.array(np.tile(model.values / model.trace, len(rows))),
                 pa.array(np.full(count, error))],
                names=[f.split()[0] for f in WHITENED.split(", ")])

    return vectors.select("vec_id", column).mapInArrow(run, WHITENED)
