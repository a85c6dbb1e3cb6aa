"""Name similarity: token-sort ratio and an exact search for the best match."""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The comparison travels to the workers as code, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Names and queries that one task compares at once, and characters of either.
NAMES, QUERIES, CHARS = 4096, 1024, 1 << 22
# Lengths in one band differ by less than this factor.
BAND = 1.25
# Times a character counts on its own in the bound; further ones count together.
TIMES = 8
# Names that a query is first held against: 4 + 8 + 16 + 32.
FEW = 60
# Columns of a matrix product, and cells of a table of masks or codes.
COLUMNS, CELLS = 4096, 1 << 21
# Texts up to these lengths are compared many pairs at a time, one machine word a text.
WORD, WORDY = 64, 256


def token_sort(name: Column) -> Column:
    """A name with its words in code point order; never null."""
    words = F.array_remove(F.split(name, r"(?U)\s+"), "")
    return F.coalesce(F.array_join(F.sort_array(words), " "), F.lit(""))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each text begins and ends."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, dtype=np.uint32), np.cumsum([0, *map(len, texts)])


def _lcs_of_words(left: list[str], right: list[str]) -> np.ndarray:
    """Of many pairs whose left text fits a machine word: one step per character of the right.

    A zero bit in ``rest`` is a character of the left text that the subsequence uses.
    """
    texts = [*left, *right]
    codes, ends = _codes(texts)
    alphabet, codes = np.unique(codes, return_inverse=True)
    sizes = np.diff(ends)
    unused = len(alphabet)  # right texts are filled up with a character that no text has
    n = len(left)
    width = int(sizes[n:].max(initial=0))
    row = np.repeat(np.arange(2 * n), sizes)
    at = np.arange(len(codes)) - ends[row]
    masks = np.zeros((n, unused + 1), dtype=np.uint64)
    own = row < n
    np.bitwise_or.at(masks, (row[own], codes[own]), np.uint64(1) << at[own].astype(np.uint64))
    other = np.full((width, n), unused)
    other[at[~own], row[~own] - n] = codes[~own]
    rest, rows = np.full(n, ~np.uint64(0)), np.arange(n)
    for column in other:
        used = rest & masks[rows, column]
        rest = (rest + used) | (rest - used)
    return np.bitwise_count(~rest).astype(np.int64)


def _lcs_of_long(left: str, right: str) -> int:
    """Of one pair: the longer text is one large number, the shorter is gone through."""
    short, long = sorted((left, right), key=len)
    codes, full = _codes([long])[0], (1 << len(long)) - 1
    masks = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little")
             for c in set(short)}
    rest = full
    for c in short:
        used = rest & masks[c]
        if used:
            rest = ((rest + used) | (rest - used)) & full
    return len(long) - rest.bit_count()


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Longest common subsequence of each pair, 64 characters a step.

    Memory is set by the characters of a few thousand names or by the longest single pair.
    """
    out = np.zeros(len(left), dtype=np.int64)
    wordy = []
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        if x == y:
            out[i] = len(x)
        elif min(len(x), len(y)) <= WORD and max(len(x), len(y)) <= WORDY:
            wordy.append((i, x, y) if len(x) <= len(y) else (i, y, x))
        else:
            out[i] = _lcs_of_long(x, y)
    wordy.sort(key=lambda pair: len(pair[2]))  # long texts do not widen the others
    at = 0
    while at < len(wordy):
        part, letters = [], set()
        while at < len(wordy) and (len(part) + 1) * (len(letters) + WORDY) <= CELLS:
            part.append(wordy[at])
            letters.update(wordy[at][1], wordy[at][2])
            at += 1
        out[[i for i, _, _ in part]] = _lcs_of_words(
            [x for _, x, _ in part], [y for _, _, y in part])
    return out


def _marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each character of the texts with its occurrence as one number, up to TIMES: rows, numbers.

    Also how many characters of each text come after that.
    """
    codes, ends = _codes(texts)
    rows = np.repeat(np.arange(len(texts)), np.diff(ends))
    order = np.lexsort((codes, rows))
    codes, rows = codes[order].astype(np.int64), rows[order]
    first = np.r_[True, (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])][:len(codes)]
    starts = np.flatnonzero(first)
    time = np.arange(len(codes)) - np.repeat(starts, np.diff(np.r_[starts, len(codes)]))
    early = time < TIMES
    more = np.bincount(rows[~early], minlength=len(texts)).astype(np.float32)
    return rows[early], codes[early] * TIMES + time[early], more


def _in_common(queries: list[str], names: list[str]) -> np.ndarray:
    """For all pairs a bound on the characters in common, order aside; exact for ordinary names.

    A matrix product over the characters of the queries, some thousand of them at a time.
    """
    sides = [_marks(queries), _marks(names)]
    places = np.unique(sides[0][1])
    common = np.minimum.outer(sides[0][2], sides[1][2])
    for low in range(0, len(places), COLUMNS):
        some = places[low:low + COLUMNS]
        bags = []
        for texts, (rows, marks, _) in zip((queries, names), sides, strict=True):
            at = np.minimum(np.searchsorted(some, marks), len(some) - 1)
            known = some[at] == marks
            bag = np.zeros((len(texts), len(some)), dtype=np.float32)
            bag[rows[known], at[known]] = 1
            bags.append(bag)
        common += bags[0] @ bags[1].T
    return common


def best_of_block(queries: list[str], names: list[str], threshold: int,
                  ) -> tuple[list[int], list[int], list[float]]:
    """The names most similar to each query, all of them on ties: places and similarity.

    Characters in common, order aside, bound the similarity from above; one matrix product gives
    them for all pairs. Pairs are compared in the order of the bound, and a query is done when no
    bound is left that reaches its best.
    """
    common = _in_common(queries, names)
    own, other = (np.array([len(x) for x in texts]) for texts in (queries, names))
    bound = 200.0 * common / np.maximum(own[:, None] + other[None, :], 1)
    # the first few names in the order of the bound; few queries need more
    few = min(FEW, len(names))
    order = np.argpartition(-bound, few - 1, axis=1)[:, :few] if few else np.zeros(
        (len(queries), 0), dtype=np.int64)
    order = np.take_along_axis(order, np.argsort(-np.take_along_axis(bound, order, 1), 1), 1)
    best = np.full(len(queries), float(threshold))
    found: list[list[tuple[int, float]]] = [[] for _ in queries]
    at, step = 0, 4
    todo = np.arange(len(queries))
    while len(todo) and at < len(names):
        if at == few:  # the others, after those that are done
            bound[todo[:, None], order[todo]] = np.inf
            rest = np.zeros((len(queries), len(names)), dtype=np.int32)
            rest[todo] = np.argsort(-bound[todo], axis=1, kind="stable")
            order = rest
        chosen = order[todo, at:at + step]
        wanted = bound[todo[:, None], chosen] >= best[todo][:, None] - 1e-3
        rows, columns = np.nonzero(wanted)
        q, n = todo[rows], chosen[rows, columns]
        lcs = lcs_lengths([queries[i] for i in q], [names[i] for i in n])
        score = 200.0 * lcs / np.maximum(own[q] + other[n], 1)
        for i, j, value in zip(q.tolist(), n.tolist(), score.tolist(), strict=True):
            if value > best[i] or (value == best[i] and not found[i]):
                best[i], found[i] = value, [(j, value)]
            elif value == best[i]:
                found[i].append((j, value))
        todo = todo[wanted.all(1)]
        at, step = at + step, 2 * step
    hits = [(i, j, value) for i, own_hits in enumerate(found) for j, value in own_hits]
    return tuple(map(list, zip(*hits, strict=True))) if hits else ([], [], [])


def best_matches(queries: DataFrame, names: DataFrame, threshold: int) -> DataFrame:
    """For each query its most similar names at or above the threshold: a, sorted, score.

    Both sides hold distinct texts in ``sorted``. Ties are all returned. Names and queries are
    dealt into bands by length, as too different lengths cannot be similar, and the bands into
    blocks by hash; each block of queries meets each block of names of the bands in reach. A task
    so holds a bounded number of both and of their characters, and there is no key to be hot. The
    work grows with the product of both counts: at low thresholds any two names have so much in
    common that no index on characters beats comparing them by matrix products (figures in
    """
    reach = math.ceil(math.log((200 - threshold) / threshold) / math.log(BAND) + 1e-9)
    band = F.floor(F.log(F.greatest(F.length("sorted"), F.lit(1))) / math.log(BAND) + 1e-9)
    near = F.explode(F.sequence(F.col("own") - reach, F.col("own") + reach))
    asked = queries.select("sorted", band.cast("int").alias("own")).select(
        F.col("sorted").alias("a"), near.alias("band"))
    known = names.select("sorted", band.cast("int").alias("band"))

    def blocks(text: str, rows: int) -> Column:
        return F.ceil(F.greatest(
            F.count("*") / rows, F.sum(F.length(text)) / CHARS)).cast("int")

    # a row per band of lengths
    sizes = F.broadcast(
        known.groupBy("band").agg(blocks("sorted", NAMES).alias("n_blocks"))
        .join(asked.groupBy("band").agg(blocks("a", QUERIES).alias("q_blocks")), "band"))

    def dealt(rows: DataFrame, text: str, own: str, every: str) -> DataFrame:
        one = F.pmod(F.xxhash64(text), F.col(own)).cast("int").alias(f"{own}_at")
        all_ = F.explode(F.sequence(F.lit(0), F.col(every) - 1)).alias(f"{every}_at")
        return rows.join(sizes, "band").select(text, "band", one, all_)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, others = left["a"].to_pylist(), right["sorted"].to_pylist()
        hits = best_of_block(texts, others, threshold) if texts and others else ([], [], [])
        return pa.table({"a": pa.array([texts[i] for i in hits[0]], pa.string()),
                         "sorted": pa.array([others[j] for j in hits[1]], pa.string()),
                         "score": pa.array(hits[2], pa.float64())})

    keys = ["band", "q_blocks_at", "n_blocks_at"]
    left = dealt(asked, "a", "q_blocks", "n_blocks").groupBy(*keys)
    right = dealt(known, "sorted", "n_blocks", "q_blocks").groupBy(*keys)
    return left.cogroup(right).applyInArrow(run, "a string, sorted string, score double")
