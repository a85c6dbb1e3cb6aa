"""Exact search for the largest inner products with a pivot-distance index.

With one more coordinate every vector gets the same length, so that the largest inner product with
a query belongs to the nearest vector. Each vector is keyed by its nearest pivot and the distance
to it; the vectors of a pivot are cut into annuli of distances. A query first searches the annulus
it lies nearest to. The score of its k-th hit bounds how far better hits can be, and by the
triangle inequality only annuli within that distance are searched as well. Scores are integers and
exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise

SCALE = 64
K = 20
PIVOTS = 32
# At most so many annuli per pivot, as many as leave about ANNULUS vectors in each.
RINGS, ANNULUS = 64, 4096
# Vectors that the pivots and the annuli's edges are chosen from.
FIT_ROWS = 8192
# Vectors and queries that one task compares at once.
BLOCK, ASKED = 8192, 2048
# Sums of products below this are exact as doubles, and as 64-bit numbers.
DOUBLE, LONG = 1 << 52, 1 << 62

# Below any score that is returned.
LOWEST = -(1 << 63)

INDEX = ("row long, vec_id long, vector binary, norm double, annulus int, far double, "
         "home int")
HITS = "row long, query_id long, vec_id long, score long"


def quantised(batch: pa.RecordBatch, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of the vectors that take part, zeros at the end, and their places."""
    rows, at = [], []
    for i, vector in enumerate(batch.column("embedding").to_pylist()):
        if vector is None or None in vector:
            continue
        x = np.array(vector, dtype=np.float64)
        if np.isfinite(x).all():
            out = np.zeros(width)
            out[:len(x)] = np.floor(scale * x)
            rows.append(out)
            at.append(i)
    return np.array(rows).reshape(len(rows), width), np.array(at, dtype=np.int64)


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    """Vectors with one more coordinate that makes all squared lengths `square`."""
    rest = np.sqrt(np.maximum(square - (x * x).sum(1), 0))
    return np.concatenate((x, rest[:, None]), axis=1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Layout:
    """Pivots and the inner edges of the annuli of each pivot; `kind` holds a component."""

    width: int
    square: float
    kind: str
    pivots: np.ndarray
    edges: np.ndarray

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Annulus and distance to its pivot of each vector."""
        far = distances(lifted(x, self.square), self.pivots)
        pivot = far.argmin(1)
        far = far[np.arange(len(x)), pivot]
        ring = (far[:, None] >= self.edges[pivot]).sum(1)
        return (pivot * (self.edges.shape[1] + 1) + ring).astype(np.int32), far

    def asked(self, x: np.ndarray) -> np.ndarray:
        """Distance of each query, whose further coordinate is 0, to every pivot."""
        return distances(np.concatenate((x, np.zeros((len(x), 1))), axis=1), self.pivots)


@dataclass
class Directory:
    """The annuli that hold vectors: their numbers, nearest and farthest distance, and sizes."""

    annulus: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    size: np.ndarray

    def bounds(self, far: np.ndarray) -> np.ndarray:
        """Smallest distance that a vector of each annulus can have from each query.

        far: distances of the queries to all pivots.
        """
        own = far[:, self.pivot]
        return np.maximum(np.maximum(own - self.high, self.low - own), 0)


def fit(sample: np.ndarray, rows: int, square: float, pivots: int = PIVOTS, seed: int = 0,
        kind: str = "<i4") -> Layout:
    """Pivots by a few rounds of k-means over the sample, edges at its quantiles."""
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    x = lifted(sample, square)
    x = np.unique(x, axis=0) if len(x) else np.zeros((1, width + 1))
    chosen = x[rng.choice(len(x), min(pivots, len(x)), replace=False)]
    for _ in range(5):
        near = distances(x, chosen).argmin(1)
        chosen = np.stack([x[near == k].mean(0) if (near == k).any() else chosen[k]
                           for k in range(len(chosen))])
    rings = int(np.clip(rows // (len(chosen) * ANNULUS), 1, RINGS))
    far = distances(x, chosen)
    near, edges = far.argmin(1), np.zeros((len(chosen), rings - 1))
    for k in range(len(chosen)):
        own = far[near == k, k]
        if len(own):
            edges[k] = np.quantile(own, np.arange(1, rings) / rings)
    return Layout(width, square, kind, chosen, edges)


def index(vectors: DataFrame, layout: Layout, every: int, scale: int = SCALE) -> DataFrame:
    """One row per vector that takes part, with its annulus; `home` is -1 but for queries.

    The row number is unique; the table is meant to be written once and read from then on.
    """
    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            x, at = quantised(batch, layout.width, scale)
            ids = batch.column("vec_id").take(pa.array(at)).cast(pa.int64())
            annulus, far = layout.place(x)
            asks = np.array([i is not None and i % every == 0 for i in ids.to_pylist()], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(at))), ids,
                 pa.array([v.astype(layout.kind).tobytes() for v in x], pa.binary()),
                 pa.array((x * x).sum(1)), pa.array(annulus), pa.array(far),
                 pa.array(np.where(asks, 0, -1).astype(np.int32))],
                names=["row", "vec_id", "vector", "norm", "annulus", "far", "home"])
            row += len(at)

    return vectors.select("vec_id", "embedding").mapInArrow(run, INDEX)


def directory(indexed: DataFrame, rings: int) -> Directory:
    """Of as many rows as there are annuli, at most PIVOTS * RINGS."""
    found = indexed.groupBy("annulus").agg(
        F.min("far").alias("low"), F.max("far").alias("high"), F.count("*").alias("size")
    ).orderBy("annulus").toArrow()
    annulus = found["annulus"].to_numpy()
    return Directory(annulus, annulus // rings, found["low"].to_numpy(), found["high"].to_numpy(),
                     found["size"].to_numpy())


def visits(asked: DataFrame, layout: Layout, known: Directory, first: bool) -> DataFrame:
    """The annuli a query has to search: its row with `annulus` and `least`.

    asked: row, vec_id, vector and, after the first search, least, the score of the k-th hit. At
    first each query has the one annulus it is nearest to, where one that reaches around the query
    comes before others. Then it has all others that may hold a score of `least` or more.
    """
    def run(batches):
        slack = 1e-6 * (1 + np.sqrt(layout.square))
        for batch in batches:
            x = np.array([np.frombuffer(v.as_py(), layout.kind) for v in batch.column("vector")],
                         float).reshape(len(batch), layout.width)
            far = layout.asked(x)
            bounds = known.bounds(far)
            middle = np.abs(far[:, known.pivot] - (known.low + known.high) / 2)
            home = np.lexsort((middle, bounds), axis=1)[:, 0]
            if first:
                query, place = np.arange(len(x)), home
                least = np.full(len(x), LOWEST)
            else:
                least = batch.column("least").to_numpy()
                reach = (x * x).sum(1) + layout.square - 2 * least.astype(float)
                open_ = bounds <= np.sqrt(np.maximum(reach, 0))[:, None] + slack
                open_[np.arange(len(x)), home] = False
                query, place = np.nonzero(open_)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(query)) for c in ("row", "vec_id", "vector")),
                 pa.array(known.annulus[place].astype(np.int32)), pa.array(least[query])],
                names=["row", "vec_id", "vector", "annulus", "least"])

    return asked.mapInArrow(
        run, "row long, vec_id long, vector binary, annulus int, least long")


def compared(vectors: pa.Table, queries: pa.Table, k: int, layout: Layout) -> pa.Table:
    """Of each query the k best of the vectors, its own id apart, that reach its `least`.

    No sum of products, nor any part of it, is larger than the largest squared length. By that the
    products are taken in doubles, in 64-bit numbers or in whole numbers of any size, and exact.
    """
    kind = (np.float64 if layout.square < DOUBLE else np.int64 if layout.square < LONG else object)
    ids = vectors["vec_id"].to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    x, q = (np.stack([np.frombuffer(v.as_py(), layout.kind) for v in table["vector"]]).astype(kind)
            for table in (vectors, queries))
    x, ids, own = x[order], ids[order], queries["vec_id"].to_numpy()
    rows, least = queries["row"].to_numpy(), queries["least"].to_numpy()
    out = [[], [], [], []]
    scores = q @ x.T
    for i, line in enumerate(scores.astype(np.int64) if kind is not object else scores):
        at = np.flatnonzero(((line >= least[i]) | (least[i] == LOWEST)) & (ids != own[i]))
        if len(at) > k:
            ordered = np.sort(line[at]) if kind is object else np.partition(line[at], -k)
            bound = ordered[-k]
            at = at[line[at] >= bound]
            at = at[np.argsort(-line[at], kind="stable")[:k]]  # equal scores by smaller id
        if kind is object and any(not LOWEST <= s < -LOWEST for s in line[at]):
            raise ValueError("a score leaves 64 bits")
        for column, values in zip(out, (np.full(len(at), rows[i]), np.full(len(at), own[i]),
                                        ids[at], line[at].astype(np.int64)), strict=True):
            column.append(values)
    return pa.table([pa.array(np.concatenate(c).astype(np.int64)) for c in out],
                    names=["row", "query_id", "vec_id", "score"])


def scan(indexed: DataFrame, asked: DataFrame, k: int, layout: Layout) -> DataFrame:
    """The hits of every query in the annuli it asks for.

    Vectors and queries of an annulus are dealt into blocks by their row numbers, and every block
    of the one meets every block of the other, so a group holds a bounded number of both. How many
    blocks there are is known from a table with a row per annulus.
    """
    sizes = indexed.groupBy("annulus").agg(F.count("*").alias("size"))
    wanted = asked.groupBy("annulus").agg(F.count("*").alias("wanted"))
    blocks = F.broadcast(sizes.join(wanted, "annulus").select(
        "annulus", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("wanted") / ASKED).cast("int").alias("asks")))

    def dealt(rows: DataFrame, own: str, every: str) -> DataFrame:
        """The block of each row by its number, repeated for all blocks of the other side."""
        one = F.pmod(F.xxhash64("row"), F.col(own)).cast("int").alias(f"{own}_at")
        all_ = F.explode(F.sequence(F.lit(0), F.col(every) - 1)).alias(f"{every}_at")
        return rows.join(blocks, "annulus").select(*rows.columns, one, all_)

    keys = ["annulus", "blocks_at", "asks_at"]
    vectors = dealt(indexed.select("row", "vec_id", "vector", "annulus"), "blocks", "asks")
    queries = dealt(asked, "asks", "blocks")
    empty = pa.schema([(c, pa.int64()) for c in ("row", "query_id", "vec_id", "score")])

    def run(x: pa.Table, q: pa.Table) -> pa.Table:
        if not len(x) or not len(q):
            return empty.empty_table()
        return compared(x, q, k, layout)

    return vectors.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(run, HITS)


def best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query row, ranked; Spark keeps k per task before the shuffle."""
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, k: int = K, every: int = 20, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of the k largest inner products of each query.

    vectors: vec_id and embedding; other columns are ignored. Queries are the rows whose id is
    divisible by `every`, candidates all rows but those with the query's id; ties go to the smaller
    id, fewer than k candidates are all returned. Components become floor(scale * x); one that
    leaves 64 bits, or a returned score that does, stops the query with a ValueError. Vectors that are null or hold a null or a non-finite component take no part, nor do
    null ids; shorter vectors count as filled up with zeros. Repeated rows are candidates each, and
    a query row that is repeated is answered each time. Empty tables give no rows.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    sizes = rows.agg(F.count("*").alias("rows"), F.max(F.size("embedding")).alias("width")).first()
    width = int(sizes.width or 0)
    if not sizes.rows or not width:
        rows = rows.where("false")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select(
        "vec_id", "embedding").toArrow().combine_chunks().to_batches()
    x = quantised(sample[0], width, scale)[0] if sample else np.zeros((0, width))

    finite = F.filter("embedding", lambda v: v.isNotNull() & ~F.isnan(v)
                      & (F.abs(v) < float("inf")))
    scaled = F.transform(finite, lambda v: v.cast("double") * scale)
    # a double beyond 2^53 is whole
    whole = F.transform(scaled, lambda v: F.when(
        F.abs(v) < 2.0 ** 53, F.floor(v).cast("double")).otherwise(v))
    largest = rows.agg(
        F.max(F.aggregate(whole, F.lit(0.0), lambda a, v: a + v * v)).alias("square"),
        F.max(F.array_max(F.transform(whole, lambda v: F.abs(v)))).alias("top")).first()
    square, top = float(largest.square or 0.0), float(largest.top or 0.0)
    if top >= 2.0 ** 63:
        raise ValueError(f"a component times {scale} leaves 64 bits")
    layout = fit(x, sizes.rows, square, kind="<i4" if top < 2.0 ** 31 else "<i8")

    indexed = materialise(index(rows, layout, every, scale))
    known = directory(indexed, layout.edges.shape[1] + 1)
    if not len(known.annulus):
        return indexed.select(F.col("vec_id").alias("query_id"), F.col("home").alias("rank"),
                              "vec_id", F.col("row").alias("score"))
    asked = indexed.where("home = 0").select("row", "vec_id", "vector")
    first = materialise(best(scan(
        indexed, visits(asked, layout, known, first=True), k, layout), k))
    least = first.where(F.col("rank") == k).select("row", F.col("score").alias("least"))
    asked = asked.join(least, "row", "left").withColumn(
        "least", F.coalesce("least", F.lit(LOWEST)))
    more = scan(indexed, materialise(visits(asked, layout, known, first=False)), k, layout)
    return best(first.drop("rank").unionByName(more), k).select(
        "query_id", "rank", "vec_id", "score")
