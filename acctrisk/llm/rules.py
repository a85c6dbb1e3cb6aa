"""Quality rules: an isolation forest over rule statistics of whole texts.

A tree splits a small random sample by random features at random values until rows stand alone.
Rows that few splits isolate are unusual. The mean path length over many trees gives a score, and
labelled rows set the score from which a text is rejected. Every tree draws its sample from all
labelled rows, and all of them set that score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise, slices, texts_of

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

TREES = 200
TREE_ROWS = 256
# Slices of the range of scores in which rows are ranked.
SCORE_SLICES = 4096
# How much worse it is to reject a share of the good rows than to keep that share of the bad ones.
GOOD_WEIGHT = 5.0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Every count reaches the forest. Lines and word windows that repeat are one feature, the mean of
# both shares: as two they outweigh the others where passages are common to many clean texts.
FEATURES = ["symbols", "bars", "marks", "upper", "same_neighbours", "repeated", "word_chars",
            "n_words"]
MEASURED = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"


def covered_by_repeats(ids: np.ndarray, distinct: int, window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more, the first ones included.

    Windows get their numbers by exact ranking, never by a hash: ids are joined to one integer
    where they fit into 63 bits, else ranked two at a time.
    """
    if len(ids) <= window:
        return 0
    count = len(ids) - window + 1
    codes, size = ids[:count].astype(np.int64), max(distinct, 1)
    for k in range(1, window):
        if size * distinct >= 1 << 62:
            codes = np.unique(codes, return_inverse=True)[1]
            size = int(codes.max()) + 1
        codes = codes * distinct + ids[k:k + count]
        size *= distinct
    _, which, times = np.unique(codes, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The rule counts of a text and the scaled features of the forest.

    Features are on a logarithmic scale: shares, which do not depend on the length of a text, the
    mean length of a word and the number of words.
    """
    raw = text.encode()
    words = raw.split()  # splits at the ASCII white space \\x20 and \\x09-\\x0D, and only there
    n = len(words)
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    of_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    white = int(of_byte[32] + of_byte[9:14].sum())
    chars = len(raw) - int(of_byte[128:192].sum()) - white
    symbols = int(of_byte[list(SYMBOLS)].sum())
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    dup = len(lines) - len(set(lines))
    repeats = covered_by_repeats(ids, len(seen))
    letters = int(of_byte[65:91].sum() + of_byte[97:123].sum())
    shares = np.array([
        symbols / max(n, 1), int(of_byte[ord("|")]) / max(n, 1),
        int(of_byte[ord("!")] + of_byte[ord("?")]) / max(n, 1),
        int(of_byte[65:91].sum()) / max(letters, 1),
        float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
        (dup / max(len(lines), 1) + repeats / max(n, 1)) / 2,
    ])
    sizes = np.array([chars / max(n, 1), n])
    return ([n, chars, symbols, dup, repeats],
            [*np.log(0.01 + shares).tolist(), *np.log1p(sizes).tolist()])


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Too few words, or too many in repeated windows. Columns as in COUNTS."""
    n, repeats = counts[:, 0], counts[:, 4]
    return (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0))


@dataclass
class Forest:
    """Trees as arrays, one row per tree and one column per node; leaves point at themselves."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    depth: int
    rows: int
    threshold: float = np.inf

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores from 0 to 1; about 0.5 for usual rows."""
        total, every = np.zeros(len(x)), np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                down = x[every, self.feature[t][node]] < self.split[t][node]
                node = np.where(down, self.left[t][node], self.right[t][node])
            total += self.path[t][node]
        return 2.0 ** (-total / len(self.feature) / max(float(_mean_path(self.rows)), 1e-9))


def fit_forest(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 0) -> Forest:
    """Random trees over samples of the rows of x. Without rows every score is the same."""
    rng, rows = np.random.default_rng(seed), min(rows, len(x))
    return grown([x[rng.choice(len(x), rows, replace=False)] if rows else x[:0]
                  for _ in range(trees)], rng)


def grown(samples: list[np.ndarray], rng: np.random.Generator) -> Forest:
    """A random tree over each sample; samples are of one size."""
    trees, rows = len(samples), max(map(len, samples))
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    size = 2 ** (depth + 1)
    shape = (trees, size)
    feature, split = np.zeros(shape, np.int64), np.zeros(shape)
    left = np.tile(np.arange(size), (trees, 1))
    right, path = left.copy(), np.zeros(shape)
    for t, sample in enumerate(samples):
        todo = [(0, sample, 0)]
        free = 1
        while todo:
            node, part, at = todo.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (np.zeros(1), np.zeros(1))
            open_ = np.flatnonzero(high > low)
            if at == depth or len(part) < 2 or not len(open_):
                path[t, node] = at + float(_mean_path(len(part)))
                continue
            f = int(rng.choice(open_))
            s = rng.uniform(low[f], high[f])
            feature[t, node], split[t, node] = f, s
            left[t, node], right[t, node] = free, free + 1
            down = part[:, f] < s
            todo += [(free, part[down], at + 1), (free + 1, part[~down], at + 1)]
            free += 2
    return Forest(feature, split, left, right, path, depth, max(rows, 2))


def calibrate(scores: np.ndarray, good: np.ndarray, weight: float = GOOD_WEIGHT) -> float:
    """The score above which to reject: most bad rows caught for fewest good ones, as weighted.

    Without rows of both labels nothing is rejected.
    """
    if good.all() or not good.any():
        return float("inf")
    order = np.argsort(-scores, kind="stable")
    ranked, value = good[order], scores[order]
    gain = (np.cumsum(~ranked) / (~good).sum()
            - weight * np.cumsum(ranked) / good.sum())
    gain[:-1][value[1:] == value[:-1]] = -np.inf  # rows of equal score go together
    best = int(np.argmax(gain))
    if gain[best] <= 0:
        return float("inf")
    below = value[best + 1] if best + 1 < len(value) else value[best] - 1e-6
    return float((value[best] + below) / 2)


def calibrate_all(scored: DataFrame, weight: float = GOOD_WEIGHT) -> float:
    """The same from a table of score (0 to 1) and good (boolean), of any number of rows.

    Rows are ranked within slices of the range of scores; one row per slice reaches the driver.
    """
    levels = materialise(scored.groupBy("score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    all_good, all_bad = levels.agg(F.sum("good"), F.sum("bad")).first()
    if not all_good or not all_bad:
        return float("inf")
    ranked = Window.partitionBy("slice").orderBy(F.desc("score"))
    gain = F.col("bad") / F.lit(all_bad) - F.lit(weight) * F.col("good") / F.lit(all_good)
    tops = (
        levels.withColumn("slice", F.floor(F.col("score") * SCORE_SLICES))
        .withColumns({c: F.sum(c).over(ranked) for c in ("good", "bad")})
        .groupBy("slice").agg(
            F.max("good").alias("good"), F.max("bad").alias("bad"),
            F.max(F.struct(gain.alias("gain"), "score", "good", "bad")).alias("top"))
        .orderBy(F.desc("slice")).collect()
    )
    best, value, good, bad = 0.0, None, 0, 0
    for row in tops:
        top = row.top
        gained = (bad + top.bad) / all_bad - weight * (good + top.good) / all_good
        if gained > best:
            best, value = gained, top.score
        good, bad = good + row.good, bad + row.bad
    if value is None:
        return float("inf")
    below = levels.where(F.col("score") < value).agg(F.max("score")).first()[0]
    return float((value + (value - 1e-6 if below is None else below)) / 2)


def measure(docs: DataFrame) -> DataFrame:
    """Rule counts and forest features of every whole text; see MEASURED for the columns.

    One row per input row. A null or empty text has zero words. Ids may be null. Other columns
    are ignored. Nothing is shuffled.
    """
    def run(batches):
        for batch in slices(batches):
            found = [statistics(x) for x in texts_of(batch)]
            counts = np.array([c for c, _ in found], dtype=np.int64).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c) for c in counts),
                 pa.array([f for _, f in found], pa.list_(pa.float64()))],
                names=["doc_id", *COUNTS, "features"])

    return docs.select("doc_id", "text").mapInArrow(run, MEASURED)


def labelled(measured: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, label, features, n_words and n_repeat_words of every labelled document.

    Null ids and labels are left out; of several labels or texts of an id the smallest counts.
    """
    of_id = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))
    )
    return (
        measured.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.min(F.struct("features", "n_words", "n_repeat_words")).alias("row"))
        .join(of_id, "doc_id").select("doc_id", "label", "row.*")
    )


def tree_samples(known: DataFrame, trees: int = TREES, rows: int = TREE_ROWS,
                 seed: int = 0) -> list[np.ndarray]:
    """The features of the rows that each tree is grown on, drawn from all given rows.

    A tree takes the rows with the smallest hashes of its number and the id, so the choice does not
    depend on the order or place of rows. Only hashes that are small for that many rows are
    ranked, four times as many as are taken.
    """
    total = known.count()
    bound = min(int(4 * rows / max(total, 1) * 2.0 ** 64), (1 << 64) - 1) - (1 << 63)

    def drawn(tree):
        return F.xxhash64(F.lit(seed), tree, "doc_id")

    every = F.sequence(F.lit(0), F.lit(trees - 1))
    order = Window.partitionBy("tree").orderBy(drawn(F.col("tree")), "doc_id")
    taken = (
        known.select("doc_id", "features", F.explode(
            F.filter(every, lambda t: drawn(t) <= F.lit(bound))).alias("tree"))
        .withColumn("at", F.row_number().over(order)).where(F.col("at") <= rows)
        .select("tree", "at", "features").orderBy("tree", "at").toArrow()
    )
    x = np.array(taken["features"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    ends = np.searchsorted(taken["tree"].to_numpy(), np.arange(1, trees))
    return np.split(x, ends)


def fit(measured: DataFrame, labels: DataFrame, label: str = "quality", seed: int = 0) -> Forest:
    """A forest and its threshold from all labelled documents.

    What reaches the driver are the trees' samples, TREES times TREE_ROWS rows at most, and one row
    per slice of scores.
    """
    known = materialise(labelled(measured, labels, label))
    forest = grown(tree_samples(known, seed=seed), np.random.default_rng(seed))

    def run(batches):
        for batch in batches:
            counts = np.zeros((len(batch), len(COUNTS)), dtype=np.int64)
            counts[:, 0], counts[:, 4] = (
                batch.column(c).to_numpy() for c in ("n_words", "n_repeat_words"))
            x = np.array(batch.column("features").to_pylist(), dtype=float)
            open_ = ~base_failed(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(forest.scores(x.reshape(-1, len(FEATURES))[open_])),
                 pa.array(batch.column("label").to_numpy()[open_] == 1)], names=["score", "good"])

    forest.threshold = calibrate_all(known.mapInArrow(run, "score double, good boolean"))
    return forest


def judge(measured: DataFrame, forest: Forest) -> DataFrame:
    """The counts with base_failed, the anomaly score and the verdict.

    kept is false where the base rules fail and where the score is above the threshold.
    """
    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            counts = np.stack([table[c].to_numpy() for c in COUNTS], axis=1)
            x = np.array(table["features"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            failed, score = base_failed(counts), forest.scores(x)
            kept = ~failed & (score <= forest.threshold)
            yield from (
                table.drop_columns(["features"])
                .append_column("base_failed", pa.array(failed))
                .append_column("kept", pa.array(kept))
                .append_column("anomaly", pa.array(score)).to_batches()
            )

    return measured.mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", base_failed boolean, kept boolean, anomaly double")


def keep(docs: DataFrame, forest: Forest) -> DataFrame:
    """The documents that rules and forest keep, with all their columns, in one pass.

    Null and empty texts go, having too few words; repeated rows are judged alike; ids may be null,
    and an empty table gives no rows. Nothing is shuffled.
    """
    def run(batches):
        for batch in slices(batches):
            found = [statistics(x) for x in texts_of(batch)]
            counts = np.array([c for c, _ in found], dtype=np.int64).reshape(-1, len(COUNTS))
            x = np.array([f for _, f in found], dtype=float).reshape(-1, len(FEATURES))
            good = ~base_failed(counts) & (forest.scores(x) <= forest.threshold)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
