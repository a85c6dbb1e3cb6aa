"""Language identification by string kernels.

Two texts are as similar as the character n-grams they share: the blended spectrum kernel counts
the n-grams of all lengths up to three that are present in both, over the geometric mean of how
many each has. A sample of landmark texts (Nyström) turns the kernel into a short vector, on which
one ridge regression per language, each against the rest, gives the scores. A batch of texts is
scored by products of its presence matrix with the landmarks' and one with the weights. The columns
of the presence matrix are the landmarks' own n-grams, told apart exactly; of a text's other
n-grams only the number counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise, slices, texts_of
from acctrisk.llm.hashing import mixed

UNKNOWN = "und"
# Lengths of n-grams; three code points of 21 bits are what one number holds.
MAX_N = 3
POINT_BITS = 21
LANDMARKS = 128
# Distinct n-grams of a text that its landmark has at most; bounds the model (24 MB, as a rule far below 1 MB).
LANDMARK_GRAMS = 8192
RIDGE = 1e-3
# Texts per language for fitting, on average at most.
FIT_ROWS = 1000
# Texts and n-grams of one presence matrix.
ROWS, COLUMNS = 64, 1 << 14


def grams(text: str, max_n: int = MAX_N) -> np.ndarray:
    """The distinct n-grams of the lower-cased whole text as sorted numbers, one to one."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.int64) + 1
    code, parts = points, [points]
    for n in range(2, max_n + 1):
        code = (code[:-1] << POINT_BITS) | points[n - 1:]
        parts.append(code)
    return np.unique(np.concatenate(parts))


def landmark_grams(text: str, limit: int = LANDMARK_GRAMS) -> np.ndarray:
    """The n-grams of a text as a landmark: all, or of a very varied text those of smallest hash."""
    found = grams(text)
    if len(found) > limit:
        found = np.sort(found[np.argsort(mixed(found.astype(np.uint64)))[:limit]])
    return found


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


@dataclass
class Landmarks:
    """The n-grams of the landmark texts, and one bit per n-gram and landmark."""

    grams: np.ndarray
    bits: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Landmarks:
        every = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]))
        held = np.zeros((len(every), len(sets)), bool)
        for k, x in enumerate(sets):
            held[np.searchsorted(every, x), k] = True
        return cls(every, np.packbits(held, axis=1), np.array([len(x) for x in sets], float))

    def sets(self) -> list[np.ndarray]:
        """The n-grams of each landmark."""
        held = np.unpackbits(self.bits, axis=1, count=len(self.sizes)).astype(bool)
        return [self.grams[held[:, k]] for k in range(len(self.sizes))]

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Shared n-grams over the geometric mean of both counts; 0 for texts without n-grams.

        Exact: a text's n-grams that no landmark has count for its size alone.
        """
        if not len(self.grams):
            return np.zeros((len(sets), len(self.sizes)))
        at = [np.minimum(np.searchsorted(self.grams, x), len(self.grams) - 1) for x in sets]
        at = [i[self.grams[i] == x] for i, x in zip(at, sets, strict=True)]
        row = np.repeat(np.arange(len(sets)), [len(i) for i in at])
        used, column = np.unique(np.concatenate([np.zeros(0, np.int64), *at]), return_inverse=True)
        shared = np.zeros((len(sets), len(self.sizes)))
        for start in range(0, len(used), COLUMNS):
            block = used[start:start + COLUMNS]
            here = (column >= start) & (column < start + COLUMNS)
            present = np.zeros((len(sets), len(block)), np.float32)
            present[row[here], column[here] - start] = 1
            held = np.unpackbits(self.bits[block], axis=1, count=len(self.sizes))
            shared += present @ held.astype(np.float32)
        sizes = np.sqrt(np.outer([len(x) for x in sets], self.sizes))
        return shared / np.maximum(sizes, 1e-9)


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray
    offset: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; `und` and 0 without a letter or a learnt language."""
        names, best = [UNKNOWN] * len(texts), np.zeros(len(texts))
        at = [i for i, x in enumerate(texts) if self.languages and has_letter(x)]
        for start in range(0, len(at), ROWS):
            rows = at[start:start + ROWS]
            scores = self.landmarks.kernel([grams(texts[i]) for i in rows])
            scores = scores @ self.weights + self.offset  # about 1 for a language, 0 against it
            for i, k, value in zip(rows, scores.argmax(1), scores.max(1), strict=True):
                names[i], best[i] = self.languages[k], min(max(float(value), 0.0), 1.0)
        return names, best


def train(landmarks: Landmarks, near: np.ndarray, kernels: np.ndarray, names: list[str],
          ridge: float = RIDGE) -> Model:
    """Nyström features of all rows and a ridge regression per language.

    near: kernel among the landmarks; kernels: of every row with the landmarks.
    """
    languages = sorted(set(names))
    values, vectors = np.linalg.eigh(near)
    root = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)
    features = kernels @ root
    name = np.array(names, dtype=object)
    wanted = (name[:, None] == np.array(languages, dtype=object)[None, :]).astype(float)
    weight = 1 / wanted.sum(0)[wanted.argmax(1)]  # every language counts alike
    weight = weight / weight.sum()
    mean, target = weight @ features, weight @ wanted
    centred = (features - mean) * weight[:, None]
    solved = np.linalg.solve(
        centred.T @ (features - mean) + ridge * np.eye(features.shape[1]),
        centred.T @ (wanted - target))
    return Model(languages, landmarks, root @ solved, target - mean @ solved)


def choose_landmarks(taken: DataFrame, landmarks: int = LANDMARKS) -> Landmarks:
    """The first texts of each language in turn, in the order of the hashes of their ids."""
    def run(batches):
        for batch in slices(batches):
            sets = [landmark_grams(x).tobytes() for x in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("lang"),
                 pa.array(sets, pa.binary())], names=["doc_id", "lang", "grams"])

    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*by_hash))
    rows = (
        taken.mapInArrow(run, "doc_id long, lang string, grams binary")
        .withColumn("place", place).where(F.col("place") <= landmarks)
        .orderBy("place", "lang").limit(landmarks).select("grams").toArrow()
    )
    return Landmarks.of([np.frombuffer(x, np.int64) for x in rows["grams"].to_pylist()])


def fit(docs: DataFrame, rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> Model:
    """A model of the languages in `lang`, from about `rows` texts of each.

    docs: doc_id, text and lang; rows with a null in any of them and empty texts are left out.
    Which texts are taken depends on hashes of the ids alone; of several texts of an id the smallest
    counts. The taken texts are written once; what goes to the driver is the n-grams of the
    landmarks and a kilobyte of kernel values per taken text.
    """
    known = docs.select("doc_id", "text", "lang").dropna().where("text <> ''")
    # one small map, an entry per language, looked up where the text is: no other text is shuffled
    shares = known.groupBy("lang").agg((F.lit(float(rows)) / F.count("*")).alias("share")).agg(
        F.map_from_entries(F.collect_list(F.struct("lang", "share")))).scalar()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = materialise(
        known.where(place < F.try_element_at(shares, F.col("lang")))
        .groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row"))
        .select("doc_id", "row.*"))
    chosen = choose_landmarks(taken, landmarks)

    def run(batches):
        for batch in slices(batches):
            for start in range(0, len(batch), ROWS):
                part = batch.slice(start, ROWS)
                near = chosen.kernel([grams(x) for x in texts_of(part)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("lang"),
                     pa.array([x.tobytes() for x in near], pa.binary())],
                    names=["doc_id", "lang", "near"])

    found = taken.mapInArrow(run, "doc_id long, lang string, near binary").orderBy(
        "doc_id").toArrow()
    if not len(found):
        return Model([], chosen, np.zeros((len(chosen.sizes), 0)), np.zeros(0))
    near = np.frombuffer(b"".join(found["near"].to_pylist())).reshape(len(found), -1)
    among = chosen.kernel(chosen.sets())
    return train(chosen, among, near, found["lang"].to_pylist())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every whole text.

    One row per input row. A text that is null or has no letter is `und` with score 0. Ids may be
    null. Other columns are ignored. Nothing is shuffled.
    """
    def run(batches):
        for batch in slices(batches):
            names, scores = model.predict(texts_of(batch))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()),
                 pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: Model, min_score: float) -> DataFrame:
    """The documents whose language is known with at least `min_score`, with all their columns.

    A text that is null, empty or without a letter goes; repeated rows are judged alike; ids may be
    null, and an empty table gives no rows. Nothing is shuffled.
    """
    def run(batches):
        for batch in slices(batches):
            names, scores = model.predict(texts_of(batch))
            good = (np.array(names, dtype=object) != UNKNOWN) & (scores >= min_score)
            yield batch.filter(pa.array(good.astype(bool)))

    return docs.mapInArrow(run, docs.schema)
