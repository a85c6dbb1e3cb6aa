"""Quality classifier: a factorisation machine over hashed words and structure statistics.

A text is a vector of hashed word weights and of standardised structure statistics. The machine
adds to a linear score the products of all pairs of entries, weighted by inner products of short
factor vectors. The sum of squares identity gives all pairs in linear time:
sum over pairs <v_i, v_j> x_i x_j = 1/2 (|sum v_i x_i|^2 - sum |v_i|^2 x_i^2).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrisk.llm.common import slices, texts_of
from acctrisk.llm.rules import SYMBOLS, covered_by_repeats

BUCKETS = 4096
STATISTICS = 13
FACTORS = 8
# Labelled rows for fitting: at most this many, those with the smallest id hashes.
FIT_ROWS = 8000
EPOCHS, BATCH, RATE, DECAY = 20, 64, 0.02, 2e-4
THRESHOLD = 0.3
# Texts that become one dense matrix.
ROWS = 256


class Buckets(dict):
    """Bucket of a word; forgets all words when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = bucket = zlib.crc32(word) % BUCKETS
        return bucket


def vector(text: str, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their weights (together of length 1) and raw structure statistics.

    The statistics are shares on a logarithmic scale and, as metadata, the length of the text.
    """
    raw = text.encode()
    words = raw.lower().split()
    n = len(words)
    counts = np.bincount(np.fromiter(map(buckets.__getitem__, words), np.int64, n),
                         minlength=BUCKETS)
    at = np.flatnonzero(counts)
    weight = np.log1p(counts[at])
    weight /= max(np.sqrt((weight * weight).sum()), 1e-9)

    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    of_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    chars = len(raw) - int(of_byte[128:192].sum()) - int(of_byte[32] + of_byte[9:14].sum())
    letters = int(of_byte[65:91].sum() + of_byte[97:123].sum())
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    shares = np.array([
        of_byte[list(SYMBOLS)].sum() / max(n, 1), of_byte[ord("|")] / max(n, 1),
        (of_byte[ord("!")] + of_byte[ord("?")]) / max(n, 1),
        of_byte[65:91].sum() / max(letters, 1), of_byte[48:58].sum() / max(chars, 1),
        (of_byte[44] + of_byte[46]) / max(n, 1),
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        covered_by_repeats(ids, len(seen)) / max(n, 1),
        (ids[1:] == ids[:-1]).mean() if n > 1 else 0.0,
        len(seen) / max(n, 1), len(lines) / max(n, 1),
    ])
    statistics = np.append(np.log(0.01 + shares), [np.log(max(chars, 1) / max(n, 1)), np.log1p(n)])
    return at.astype(np.uint16), weight.astype(np.float32), statistics


@dataclass
class Machine:
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def matrix(self, vectors: list) -> np.ndarray:
        x = np.zeros((len(vectors), BUCKETS + STATISTICS), dtype=np.float32)
        for i, (at, weight, statistics) in enumerate(vectors):
            x[i, at] = weight
            x[i, BUCKETS:] = np.clip((statistics - self.mean) / self.scale, -4, 4)
        return x

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; cost linear in the entries of x."""
        summed, squares = x @ self.factors, (x * x) @ (self.factors * self.factors)
        raw = self.bias + x @ self.linear + 0.5 * (summed * summed - squares).sum(1)
        return 1 / (1 + np.exp(-np.clip(raw.astype(float), -30, 30)))


def train(vectors: list, labels: np.ndarray, seed: int = 0) -> Machine:
    """Logistic loss, adaptive steps. Without rows of both labels every score is the share of 1."""
    rng = np.random.default_rng(seed)
    statistics = np.array([s for _, _, s in vectors]).reshape(-1, STATISTICS)
    width = BUCKETS + STATISTICS
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    machine = Machine(
        statistics.mean(0) if len(statistics) else np.zeros(STATISTICS),
        np.maximum(statistics.std(0), 1e-3) if len(statistics) else np.ones(STATISTICS),
        float(np.log(share / (1 - share))), np.zeros(width, np.float32),
        (rng.standard_normal((width, FACTORS)) * 0.02).astype(np.float32))
    if len(np.unique(labels)) < 2:
        machine.factors[:] = 0
        return machine
    grown = [1e-6, np.full(width, 1e-6, np.float32), np.full((width, FACTORS), 1e-6, np.float32)]
    for _ in range(EPOCHS):
        order = rng.permutation(len(vectors))
        for start in range(0, len(order), BATCH):
            rows = order[start:start + BATCH]
            x = machine.matrix([vectors[i] for i in rows])
            error = ((machine.scores(x) - labels[rows]) / len(rows)).astype(np.float32)
            summed = x @ machine.factors
            steps = [
                float(error.sum()),
                x.T @ error + DECAY * machine.linear,
                x.T @ (error[:, None] * summed)
                - ((x * x).T @ error)[:, None] * machine.factors + DECAY * machine.factors,
            ]
            for k, step in enumerate(steps):
                grown[k] = grown[k] + step * step
                steps[k] = RATE * step / np.sqrt(grown[k])
            machine.bias -= float(steps[0])
            machine.linear -= steps[1]
            machine.factors -= steps[2]
    return machine


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS,
        seed: int = 0) -> Machine:
    """A machine learnt from at most `rows` labelled documents.

    labels: doc_id and the label (0 or 1). Null ids and labels are left out; of several labels or
    texts of an id the smallest counts. Which rows are taken depends on hashes of the ids alone.
    """
    def run(batches):
        buckets = Buckets()
        for batch in slices(batches):
            found = [vector(x, buckets) for x in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("label"),
                 *(pa.array([f[k].tobytes() for f in found], pa.binary()) for k in range(3))],
                names=["doc_id", "label", "at", "weight", "statistics"])

    sample = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    known = (
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .mapInArrow(run, "doc_id long, label int, at binary, weight binary, statistics binary")
        .groupBy("doc_id").agg(F.min(F.struct("label", "at", "weight", "statistics")).alias("row"))
        .select("doc_id", "row.*").orderBy("doc_id").toArrow()
    )
    vectors = [(np.frombuffer(a, np.uint16), np.frombuffer(w, np.float32), np.frombuffer(s, float))
               for a, w, s in zip(*(known[c].to_pylist() for c in ("at", "weight", "statistics")),
                                  strict=True)]
    return train(vectors, known["label"].to_numpy().astype(float), seed)


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from `threshold` on) of every whole text.

    One row per input row. A null text counts as empty, and empty texts have a score like any
    other. Ids may be null. Other columns are ignored. Nothing is shuffled.
    """
    def run(batches):
        buckets = Buckets()
        for batch in slices(batches):
            found = []
            for start in range(0, len(batch), ROWS):
                texts = texts_of(batch.slice(start, ROWS))
                found.append(machine.scores(machine.matrix([vector(x, buckets) for x in texts])))
            scores = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(scores),
                 pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, score double, predicted int")
