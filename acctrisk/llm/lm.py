"""Language model scoring with a causal self-attention model on subword ids.

The model has one attention layer. A token's query meets the keys of the tokens before it in the
window, learnt vectors per subword plus a bias per distance, through a causal softmax with a sink.
The value of a token is a distribution of what follows: for the token itself what comes right after
it and its predecessor, for older tokens what comes a few places later, and for the sink all
tokens. The distributions are counts over all training texts; queries, keys, biases and sink are
trained by gradient steps, in the driver on a bounded sample for a start, then in the tasks on every
window of all training texts, the mean of the tasks' results being the model. Mixing distributions gives probabilities without a softmax over
the vocabulary.

The most frequent subwords have symbols of their own; the others share one and are told apart by
their counts, so every text has a proper probability. As there is a finite number of symbols, the
products of all queries and keys fit into one small table that is computed beforehand.

A word model (counts of words over all training texts) stands beside it as a base line.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, replace

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk.llm import byte_bpe, counters
from acctrisk.llm.common import materialise, slices, texts_of
from acctrisk.llm.hashing import Powers, hashed_words

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Symbols: 0 the end of a text, 1 any rare subword, then the frequent ones; PAD stands for nothing.
SYMBOLS = 1024
# Frequent pairs of symbols that have a distribution of their own of what follows.
PAIRS = 8192
END, RARE, PAD = 0, 1, SYMBOLS
# A window is a block of context and a block whose tokens it scores; windows overlap by a block.
BLOCK = 8
FAR = 2
DIMENSIONS = 16
# The attention starts from steps on about so many windows, spread over all texts.
FIT_WINDOWS = 1 << 18
STEPS, BATCH, RATE = 300, 1024, 0.03
# Then the tasks train it on all windows: windows of a step, those looked up in one go, the rate.
TASK_BATCH, TASK_WINDOWS, TASK_RATE = 1 << 14, 1 << 12, 0.03
# Fixed point of sums over tasks: parameters, and the tasks' shares of all windows.
PARAMETER_ONE, SHARE_ONE = 1 << 24, 1 << 20
SMOOTHING = 0.1
# The most frequent words, at most so many, go to the tasks; the counts of others are joined.
HOT_WORDS = 400_000
# Counted words that a task holds.
HELD = 1 << 21
# The end of a text among the hashes of words.
END_WORD = np.uint64(0)
# Windows that are scored in one go.
WINDOWS = 1 << 12


def lowered(text: str) -> str:
    """A-Z in lower case, nothing else."""
    return text.encode().lower().decode()


def id_type(encoding) -> np.dtype:
    """Two bytes per subword id where that is enough."""
    return np.dtype("<u2" if encoding.n_vocab <= 1 << 16 else "<u4")


def prepare(docs: DataFrame, learn: Column, path: str | None = None) -> tuple[DataFrame, str]:
    """A written table of row, doc_id, learn, text and the text's subword ids; and the vocabulary.

    Texts are encoded once for all further passes. row numbers the rows of the table, repeated
    ones too; learn says which texts may be learnt from; a null text becomes an empty one.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        encoder, row = byte_bpe.PlainFirst(path), TaskContext.get().partitionId() << 33
        kind = id_type(encoder.plain)
        for batch in slices(batches):
            texts = texts_of(batch)
            ids = [encoder.encode_text(lowered(x)).astype(kind).tobytes() for x in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(texts))),
                 batch.column("doc_id").cast(pa.int64()), batch.column("learn"),
                 pa.array(texts, pa.string()), pa.array(ids, pa.binary())],
                names=["row", "doc_id", "learn", "text", "ids"])
            row += len(texts)

    rows = docs.select("doc_id", F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    return materialise(rows.mapInArrow(
        run, "row long, doc_id long, learn boolean, text string, ids binary")), path


def ids_in(batch: pa.RecordBatch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The subword ids of a batch's texts in a row, and how many each text has."""
    column = batch.column("ids").cast(pa.large_binary())
    _, ends, ids = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or ends[0] == ends[-1]:
        return np.zeros(0, kind), np.zeros(len(column), np.int64)
    return np.frombuffer(ids, np.uint8)[ends[0]:ends[-1]].view(kind), np.diff(ends) // kind.itemsize


def with_ends(symbols: np.ndarray, sizes: np.ndarray, before: int, after: int) -> np.ndarray:
    """The symbols of texts in a row, so many ends before and after those of each text."""
    line = np.full(len(symbols) + (before + after) * len(sizes), END, dtype=np.int64)
    shift = before + (before + after) * np.arange(len(sizes))
    line[np.arange(len(symbols)) + np.repeat(shift, sizes)] = symbols
    return line


# --- Counts over the training texts -------------------------------------------------------------

def count_words(docs: DataFrame) -> DataFrame:
    """How often each word is in all given texts: word (its hash; 0 for the end of a text) and n.

    Tasks hand on sums, and Spark adds them up.
    """
    def rows(codes, counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(codes.view(np.int64)), pa.array(counts)], names=["word", "n"])

    def summed(parts):
        codes, which = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        return codes, np.bincount(which, np.concatenate([n for _, n in parts])).astype(np.int64)

    def run(batches):
        powers, held, ends = Powers(), [], 0
        for batch in slices(batches):
            held.append(np.unique(hashed_words(batch, powers)[0], return_counts=True))
            ends += len(batch)
            if sum(len(c) for c, _ in held) > HELD:
                held = [summed(held)]
                if len(held[0][0]) > HELD // 2:
                    yield rows(*held.pop())
        if ends:
            yield rows(*summed([*held, (np.array([END_WORD]), np.array([ends]))]))

    return (
        docs.select("text").mapInArrow(run, "word long, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
    )


def count_subwords(texts: DataFrame, size: int, kind: np.dtype) -> np.ndarray:
    """How often each subword is in all given texts."""
    def run(batches):
        subwords = np.zeros(size, np.int64)
        for batch in slices(batches, "ids"):
            subwords += np.bincount(ids_in(batch, kind)[0], minlength=size)
        if subwords.any():
            for row in counters.pieces(TaskContext.get().partitionId(), [subwords]):
                yield counters.batch_of([row])

    return counters.added_up(texts.select("ids").mapInArrow(run, counters.COLUMNS), size)


def count_pairs(texts: DataFrame, symbol_of: np.ndarray, kind: np.dtype) -> np.ndarray:
    """How often each symbol comes right after each other one in all given texts."""
    def run(batches):
        pairs = np.zeros(SYMBOLS * SYMBOLS, np.int64)
        for batch in slices(batches, "ids"):
            # the end of a text is the end before the next one, too
            ids, sizes = ids_in(batch, kind)
            flat = np.append(with_ends(symbol_of[ids], sizes, 1, 0), END)
            pairs += np.bincount(flat[:-1] * SYMBOLS + flat[1:], minlength=len(pairs))
        if pairs.any():
            for row in counters.pieces(TaskContext.get().partitionId(), [pairs]):
                yield counters.batch_of([row])

    counted = texts.select("ids").mapInArrow(run, counters.COLUMNS)
    return counters.added_up(counted, SYMBOLS * SYMBOLS).reshape(SYMBOLS, SYMBOLS)


def chosen_symbols(subwords: np.ndarray) -> np.ndarray:
    """The symbol of each subword: the most frequent of all have one of their own."""
    frequent = np.argsort(-subwords, kind="stable")[:SYMBOLS - 2]
    frequent = frequent[subwords[frequent] > 0]
    symbol_of = np.full(len(subwords), RARE, dtype=np.int64)
    symbol_of[frequent] = 2 + np.arange(len(frequent))
    return symbol_of


def chosen_pairs(pairs: np.ndarray) -> np.ndarray:
    """The numbers of the most frequent pairs of symbols, -1 for others; nothing follows an end."""
    often = pairs.copy()
    often[:, END] = 0
    often = often.ravel()
    top = np.argsort(-often, kind="stable")[:PAIRS]
    top = top[often[top] > 1]
    pair_of = np.full((SYMBOLS + 1, SYMBOLS + 1), -1, dtype=np.int32)
    pair_of[top // SYMBOLS, top % SYMBOLS] = np.arange(len(top))
    return pair_of


def count_symbols(texts: DataFrame, symbol_of: np.ndarray, pair_of: np.ndarray, kind: np.dtype,
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts over all given texts.

    The subwords; the symbols by the symbol right before and by one up to FAR places further
    back; the symbols by the frequent pair right before. The tables have a fixed size.
    """
    size = len(symbol_of)

    def run(batches):
        subwords = np.zeros(size, np.int64)
        pairs = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
        triples = np.zeros(PAIRS * SYMBOLS, np.uint32)
        for batch in slices(batches, "ids"):
            ids, sizes = ids_in(batch, kind)
            subwords += np.bincount(ids, minlength=size)
            of_text = np.repeat(np.arange(len(sizes)), sizes + 2)
            flat = with_ends(symbol_of[ids], sizes, 1, 1)
            for distance in range(1, FAR + 2):
                same = of_text[distance:] == of_text[:-distance]
                code = (flat[:-distance] * SYMBOLS + flat[distance:])[same]
                pairs[min(distance, 2) - 1] += np.bincount(code, minlength=SYMBOLS * SYMBOLS)
            pair = pair_of[flat[:-2], flat[1:-1]]
            same = (of_text[2:] == of_text[:-2]) & (pair >= 0)
            np.add.at(triples, pair[same] * SYMBOLS + flat[2:][same], np.uint32(1))
        if subwords.any() or pairs.any():
            task = TaskContext.get().partitionId()
            for row in counters.pieces(task, [subwords, *pairs, triples]):
                yield counters.batch_of([row])

    counted = texts.select("ids").mapInArrow(run, counters.COLUMNS)
    total = counters.added_up(counted, size + (2 * SYMBOLS + PAIRS) * SYMBOLS)
    subwords, pairs, triples = np.split(total, [size, size + 2 * SYMBOLS * SYMBOLS])
    return subwords, pairs.reshape(2, SYMBOLS, SYMBOLS), triples.reshape(PAIRS, SYMBOLS)


# --- The attention model ------------------------------------------------------------------------

# Steps of the logarithms of probabilities in coded tables.
STEP = 0.08


# The probability that a number of steps stands for, but for the sum of its row.
OF_STEPS = np.exp(-STEP * np.arange(256)).astype(np.float32)


def coded(table: np.ndarray) -> np.ndarray:
    """Logarithms of a table of probabilities in steps, one byte each."""
    steps = np.clip(-np.log(np.maximum(table, 1e-12)) / STEP, 0, 255)
    return np.round(steps).astype(np.uint8)


def sums(code: np.ndarray) -> np.ndarray:
    """What the rows of a coded table add up to; divided by it they add up to 1."""
    return np.concatenate([OF_STEPS[code[i:i + 512]].sum(1, dtype=float)
                           for i in range(0, len(code), 512)])


@dataclass
class Weights:
    """What a model is made of, small enough to go to every task."""

    symbol_of: np.ndarray
    rare_log10: np.ndarray
    query: np.ndarray
    key: np.ndarray
    bias: np.ndarray
    sink: np.ndarray
    pair_of: np.ndarray
    next: bytes  # coded and compressed, by frequent pair, then by symbol, then for padding
    next_sums: np.ndarray
    far: bytes  # so, too
    plain: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        """What is trained."""
        return [self.query, self.key, self.bias, self.sink]

    def model(self) -> Model:
        next_row = np.where(self.pair_of >= 0, self.pair_of, PAIRS + np.arange(SYMBOLS + 1))
        code = np.frombuffer(zlib.decompress(self.far), np.uint8).reshape(SYMBOLS, SYMBOLS)
        far, both = OF_STEPS[code], np.zeros((SYMBOLS + 1, SYMBOLS + 1), np.complex64)
        far /= sums(code)[:, None]
        both.imag[:SYMBOLS, :SYMBOLS] = far.T
        model = Model(
            self.symbol_of, self.rare_log10, both, np.zeros(CAUSAL.shape, np.float32),
            np.zeros(SYMBOLS + 1, np.float32), next_row.astype(np.int16).ravel(),
            np.frombuffer(zlib.decompress(self.next), np.uint8), self.next_sums,
            padded(self.plain))
        model.take_over(self)
        return model


@dataclass
class Model:
    """Tables of the model; rows and columns beyond SYMBOLS stand for padding and are zero."""

    symbol_of: np.ndarray  # symbol of each subword
    rare_log10: np.ndarray  # log10 share of each subword among the rare ones, 0 for frequent ones
    # exp of query times key, by symbol of the query and of the key; as imaginary part the share of
    # a symbol, in rows, a few places after another one, in columns
    both: np.ndarray
    distance: np.ndarray  # exp of the bias by place in the block and in the window; causal
    sink: np.ndarray  # exp of the sink's score by symbol of the query
    next_row: np.ndarray  # row of a pair of symbols in the next table
    next: np.ndarray  # coded shares of the symbols right after
    next_sums: np.ndarray  # sums of its rows
    plain: np.ndarray  # any symbol

    def take_over(self, weights: Weights) -> None:
        """Go on with what is trained of these weights."""
        query = (weights.query / np.sqrt(DIMENSIONS)).astype(np.float32)
        products = query @ weights.key.T.astype(np.float32)
        self.both.real[:SYMBOLS, :SYMBOLS] = np.exp(products, out=products)
        self.distance = np.where(CAUSAL, np.exp(weights.bias[APART]), 0).astype(np.float32)
        self.sink = padded(np.exp(weights.sink))

    def log10(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text, given as subword ids.

        The text's symbols after an end are cut into blocks. A window is a block with the block
        before it; it scores what follows each token of its second block, so every token is
        scored once, the final end too.
        """
        return self.log10_of(np.concatenate(texts), np.array([len(x) for x in texts]))

    def log10_of(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same of texts in a row with so many subword ids each."""
        blocks, wanted, at, starts = cut(self.symbol_of[ids], sizes)
        total = np.zeros(len(blocks))
        for i in range(0, len(at), WINDOWS):
            total[at[i:i + WINDOWS]] = self.running(
                *windows_at(blocks, wanted, at[i:i + WINDOWS])).sum(1)
        of_text = np.repeat(np.arange(len(sizes)), sizes)
        return np.add.reduceat(total, starts) + np.bincount(
            of_text, self.rare_log10[ids], minlength=len(sizes))

    def follows(self, before: np.ndarray, query: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Share of the targets right after queries and the symbols before these."""
        row = self.next_row.take(before * (SYMBOLS + 1) + query)
        code = self.next.take(row * np.int64(SYMBOLS) + target, mode="clip")
        out = OF_STEPS.take(code)
        out /= self.next_sums.take(row)
        out *= target != PAD
        return out

    def attend(self, window: np.ndarray, target: np.ndarray):
        """Weights of all keys for all queries, what the keys' values give the targets, sinks."""
        query, key, size = window[:, BLOCK:], window[:, None, :], SYMBOLS + 1
        weight = self.both.ravel().take(query[:, :, None] * size + key, mode="clip").real
        weight = weight * self.distance
        value = self.both.ravel().take(target[:, :, None] * size + key, mode="clip").imag.copy()
        own = np.arange(BLOCK)
        value[:, own, BLOCK + own] = self.follows(window[:, BLOCK - 1:-1], query, target)
        return weight, value, self.sink[query]

    def windows(self, window: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 probability of the targets of a batch of windows; 0 for padding."""
        weight, value, sink = self.attend(window, target)
        mixed = np.einsum("wqk,wqk->wq", weight, value) + sink * self.plain[target]
        return shares_log10(mixed, np.einsum("wqk->wq", weight) + sink, target)

    def running(self, window: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The same where each target is the next token's query, as in running text."""
        window, target = turned(window), turned(target)
        total, mixed = self.sink.take(window[BLOCK:]), self.plain.take(target)
        mixed *= total
        for place, _, weight, value in self.attend_running(window, target):
            total[place] += weight.sum(0)
            mixed[place] += np.einsum("kw,kw->w", weight, value)
        return shares_log10(mixed, total, target).T

    def attend_running(self, window: np.ndarray, target: np.ndarray):
        """What `attend` gives, for running text, one place of the second block after the other.

        Windows are columns here. Place, cells of query and keys in tables of symbols, weights and
        values of the keys it sees, in arrays that the next place overwrites. What a symbol is as a
        query and as the target of the place before is looked up in one go.
        """
        n, size = window.shape[1], SYMBOLS + 1
        symbol = np.concatenate((window[BLOCK:BLOCK + 1], target)) * size
        follows = self.follows(window[BLOCK - 1:-1], window[BLOCK:], target)
        cells = np.empty((2, 2 * BLOCK, n), np.int64)
        weights = np.empty((2, 2 * BLOCK, n), np.float32)
        found, value = np.empty((2 * BLOCK, n), np.complex64), np.empty((2 * BLOCK, n), np.float32)
        for place in range(BLOCK + 1):
            keys = min(BLOCK + 1 + place, 2 * BLOCK)
            cell = np.add(symbol[place], window[:keys], out=cells[place % 2, :keys])
            both = self.both.ravel().take(cell, mode="clip", out=found[:keys])
            if place:
                last = BLOCK + place - 1  # the own token of the place before
                value[:last], value[last] = both.imag[:last], follows[place - 1]
                yield (place - 1, cells[(place - 1) % 2, :last + 1],
                       weights[(place - 1) % 2, :last + 1], value[:last + 1])
            if place < BLOCK:
                np.multiply(both.real, self.distance[place, :keys, None],
                            out=weights[place % 2, :keys])


def shares_log10(mixed: np.ndarray, total: np.ndarray, target: np.ndarray) -> np.ndarray:
    seen = target != PAD
    return np.where(seen, np.log10(np.where(seen, mixed / np.where(seen, total, 1), 1)), 0)


def turned(x: np.ndarray) -> np.ndarray:
    """Rows as columns, to look symbols up in."""
    return x.T.astype(np.int64, order="C")


def cut(symbols: np.ndarray, sizes: np.ndarray):
    """Texts, given as symbols in a row and their numbers, in blocks of symbols, two bytes each.

    The blocks, the symbols that follow each of theirs, the numbers of the blocks to score (all but
    the block of padding before each text) and the number of the first block of each text.
    """
    n_blocks = 1 + (sizes + BLOCK) // BLOCK
    starts = np.cumsum(n_blocks) - n_blocks
    first = (starts + 1) * BLOCK  # the place of the end before a text
    place = np.arange(len(symbols)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    blocks, wanted = (np.full(n_blocks.sum() * BLOCK, PAD, np.int16) for _ in range(2))
    blocks[first] = END
    blocks[place + 1] = symbols
    wanted[place] = symbols
    wanted[first + sizes] = END
    scored = np.ones(n_blocks.sum(), dtype=bool)
    scored[starts] = False
    return blocks.reshape(-1, BLOCK), wanted.reshape(-1, BLOCK), np.flatnonzero(scored), starts


def windows_at(blocks: np.ndarray, wanted: np.ndarray, k: np.ndarray):
    """The windows whose second blocks are those numbered k, and their targets."""
    return np.concatenate((blocks[k - 1], blocks[k]), axis=1), wanted[k]


def smoothed(pairs: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Distribution of the symbols of each row, drawn to `plain` by the number of kinds.

    One count less than seen is taken as known, as the fit would otherwise trust pairs that it has
    itself brought in.
    """
    known = np.maximum(pairs.astype(np.float32) - np.float32(0.75), 0)
    total = pairs.sum(1, keepdims=True)
    left = np.where(total > 0, (total - known.sum(1, keepdims=True, dtype=float))
                    / np.maximum(total, 1), 1)
    known /= np.maximum(total, 1)
    known += (left * plain).astype(np.float32)
    return known


def padded(x: np.ndarray) -> np.ndarray:
    """A number per symbol with zero for padding."""
    return np.append(x, 0).astype(np.float32)


_PLACES = np.arange(BLOCK)[:, None] + BLOCK - np.arange(2 * BLOCK)[None, :]
CAUSAL, APART = _PLACES >= 0, np.maximum(_PLACES, 0)


def build(symbol_of: np.ndarray, pair_of: np.ndarray, subwords: np.ndarray, pairs: np.ndarray,
          triples: np.ndarray, windows: np.ndarray, seed: int = 0, steps: int = STEPS) -> Weights:
    """The model of the counts, its attention trained on windows.

    subwords, pairs, triples: the results of `count_symbols`; windows: rows of 2 * BLOCK input
    symbols and the BLOCK symbols that follow those of the second half, PAD where there is none.
    """
    plain = np.bincount(symbol_of, weights=subwords, minlength=SYMBOLS).astype(float)
    plain[END] += pairs[0][:, END].sum()
    plain = (plain + 0.5) / (plain + 0.5).sum()
    rare = symbol_of == RARE
    share = np.where(rare, subwords + 0.5, 0)
    rare_log10 = np.where(rare, np.log10(np.where(rare, share, 1) / max(share.sum(), 1)), 0)
    near, far = (smoothed(x, plain) for x in pairs)
    second = np.zeros(PAIRS, np.int64)
    second[pair_of[pair_of >= 0]] = np.nonzero(pair_of >= 0)[1]
    rng = np.random.default_rng(seed)
    code = np.concatenate((coded(smoothed(triples, near[second])), coded(near),
                           np.full((1, SYMBOLS), 255, np.uint8)))
    weights = Weights(
        symbol_of, rare_log10, rng.standard_normal((SYMBOLS, DIMENSIONS)) * 0.1,
        rng.standard_normal((SYMBOLS, DIMENSIONS)) * 0.1, -0.5 * np.arange(2 * BLOCK, dtype=float),
        np.full(SYMBOLS, -2.0), pair_of, zlib.compress(code.tobytes(), 1), sums(code),
        zlib.compress(coded(far).tobytes(), 1), plain)
    adam, now = Adam(weights.parameters()), weights.model()
    for _ in range(steps if len(windows) else 0):
        rows = windows[rng.integers(0, len(windows), min(BATCH, len(windows)))].astype(np.int64)
        window, target = rows[:, :2 * BLOCK], rows[:, 2 * BLOCK:]
        added = Slopes()
        added.add(now, window, target, now.attend(window, target))
        adam.step(added, RATE)
        now.take_over(weights)
    return weights


class Slopes:
    """Slopes of minus the logarithms of targets' probabilities, added up.

    By the scores of all pairs of query and key, by the distances and by the sinks.
    """

    def __init__(self):
        self.pairs = np.zeros((SYMBOLS + 1) ** 2, np.float32)
        self.distances, self.sinks = np.zeros(2 * BLOCK), np.zeros(SYMBOLS)
        self.targets = 0

    def add(self, now: Model, window: np.ndarray, target: np.ndarray, attended) -> None:
        """Those of a batch of windows; attended: what the model attends to in them."""
        weight, value, away = attended
        query = window[:, BLOCK:]
        per_total, per_mixed = self.add_sinks(
            now, query, target, np.einsum("wqk->wq", weight), np.einsum("wqk,wqk->wq", weight, value))
        # of minus log(mixed / total) by the score of a key: weight * (1 / total - value / mixed)
        slope = value * -per_mixed[:, :, None]
        slope += per_total[:, :, None]
        slope *= weight
        cell = (query[:, :, None] * (SYMBOLS + 1) + window[:, None, :]).ravel()
        np.add.at(self.pairs, cell, slope.ravel())
        by_place = slope.sum(0, dtype=float)[CAUSAL]
        self.distances += np.bincount(APART[CAUSAL], weights=by_place, minlength=2 * BLOCK)

    def add_running(self, now: Model, window: np.ndarray, target: np.ndarray) -> None:
        """The same of windows of running text."""
        window, target = turned(window), turned(target)
        for place, cell, weight, slope in now.attend_running(window, target):
            per_total, per_mixed = self.add_sinks(
                now, window[BLOCK + place], target[place], weight.sum(0),
                np.einsum("kw,kw->w", weight, slope))
            slope *= -per_mixed
            slope += per_total
            slope *= weight
            np.add.at(self.pairs, cell.ravel(), slope.ravel())
            self.distances[:len(slope)] += slope.sum(1, dtype=float)[::-1]

    def add_sinks(self, now: Model, query: np.ndarray, target: np.ndarray, total: np.ndarray,
                  mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slopes by sinks; the reciprocals of the weights of all keys and of what they give."""
        away, plain = now.sink.take(query), now.plain.take(target)
        total, mixed = total + away, mixed + away * plain
        seen = (target != PAD) & (query != PAD)
        per_total = np.divide(1, total, out=np.zeros_like(total), where=seen)
        per_mixed = np.divide(1, mixed, out=np.zeros_like(mixed), where=seen)
        of_sink = away * (per_total - plain * per_mixed)
        self.sinks += np.bincount(
            query.ravel(), weights=of_sink.ravel(), minlength=SYMBOLS + 1)[:SYMBOLS]
        self.targets += int(seen.sum())
        return per_total, per_mixed


class Adam:
    """Gradient steps of Adam on query, key, bias and sink, which are changed in place."""

    def __init__(self, params: list[np.ndarray]):
        self.params, self.steps = params, 0
        self.moment, self.square = [0 * x for x in params], [0 * x for x in params]

    def step(self, added: Slopes, rate: float) -> None:
        targets = max(added.targets, 1)
        query, key = (x.astype(np.float32) for x in self.params[:2])
        pairs = added.pairs.reshape(SYMBOLS + 1, -1)[:SYMBOLS, :SYMBOLS]
        scale = targets * np.sqrt(DIMENSIONS)
        found = ((pairs @ key).astype(float) / scale, (pairs.T @ query).astype(float) / scale,
                 added.distances / targets, added.sinks / targets)
        self.steps += 1
        for k, slope in enumerate(found):
            self.moment[k] = 0.9 * self.moment[k] + 0.1 * slope
            self.square[k] = 0.99 * self.square[k] + 0.01 * slope * slope
            self.params[k] -= (rate * (self.moment[k] / (1 - 0.9 ** self.steps))
                               / (np.sqrt(self.square[k] / (1 - 0.99 ** self.steps)) + 1e-9))


def train(texts: DataFrame, weights: Weights, subwords: int, kind: np.dtype) -> Weights:
    """The model trained further on every window of all given texts, each looked at once.

    Tasks train from the same weights on, a task's last windows moving them by their share of a
    step. The model is the mean of their results by windows, added up in whole numbers, so that it
    does not depend on their order. subwords: about how many there are.
    """
    all_windows, lengths = subwords // BLOCK + 1, [x.size for x in weights.parameters()]

    def run(batches):
        now, windows, waiting = None, 0, 0
        for batch in slices(batches, "ids"):
            if now is None:
                now = weights.model()
                own = replace(weights, **{
                    k: getattr(weights, k).copy() for k in ("query", "key", "bias", "sink")})
                adam, added = Adam(own.parameters()), Slopes()
            ids, sizes = ids_in(batch, kind)
            blocks, wanted, at, _ = cut(weights.symbol_of[ids], sizes)
            for i in range(0, len(at), TASK_WINDOWS):
                k = at[i:i + TASK_WINDOWS]
                added.add_running(now, *windows_at(blocks, wanted, k))
                waiting, windows = waiting + len(k), windows + len(k)
                if waiting >= TASK_BATCH:
                    adam.step(added, TASK_RATE)
                    now.take_over(own)
                    waiting, added = 0, Slopes()
        if waiting:
            adam.step(added, TASK_RATE * waiting / TASK_BATCH)
        if windows:
            share = max(1, windows * SHARE_ONE // all_windows)
            trained = np.concatenate([x.ravel() for x in own.parameters()])
            shares = np.append(np.rint(trained * PARAMETER_ONE).astype(np.int64), 1) * share
            for row in counters.pieces(TaskContext.get().partitionId(), [shares]):
                yield counters.batch_of([row])

    total = counters.added_up(
        texts.select("ids").mapInArrow(run, counters.COLUMNS), sum(lengths) + 1)
    if not total[-1]:
        return weights
    means = np.split(total[:-1] / total[-1] / PARAMETER_ONE, np.cumsum(lengths)[:-1])
    query, key, bias, sink = (
        x.reshape(old.shape) for x, old in zip(means, weights.parameters(), strict=True))
    return replace(weights, query=query, key=key, bias=bias, sink=sink)


def fit_windows(texts: DataFrame, kind: np.dtype, every: int, seed: int = 0) -> np.ndarray:
    """One of `every` windows of subword ids of all texts; -1 is the end of a text, -2 padding.

    Each text gives every such window from a place on that the hash of its id says, so long texts
    are represented throughout.
    """
    width = 2 * BLOCK + 1

    def run(batches):
        for batch in slices(batches, "ids"):
            found, (flat, sizes) = [], ids_in(batch, kind)
            texts_ids = np.split(flat.astype(np.int64), np.cumsum(sizes)[:-1])
            for first, ids in zip(batch.column("first").to_pylist(), texts_ids, strict=True):
                starts = np.arange(first * BLOCK, len(ids) + 1, every * BLOCK)
                if len(starts):
                    line = np.concatenate(
                        (np.full(BLOCK, -2), [-1], ids, [-1], np.full(BLOCK, -2)))
                    found.append(np.stack([line[s:s + width] for s in starts])
                                 .astype("<i4").tobytes())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["windows"])

    first = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(every)).alias("first")
    taken = (
        texts.select(first, "ids").mapInArrow(run, "windows binary").orderBy("windows").toArrow()
    )
    lines = np.frombuffer(b"".join(taken["windows"].to_pylist()), "<i4")
    return lines.reshape(-1, width)


def fit(prepared: DataFrame, path: str, seed: int = 0) -> tuple[Weights, DataFrame]:
    """The attention model and the counted words (a table) of the texts to learn from.

    The counts cover all of them, and so does the choice of the subwords with symbols of their own
    and of the pairs with a distribution. The attention starts from a bounded sample of windows and
    is then trained on all of them.
    """
    encoding = byte_bpe.load(path)
    size, kind = encoding.n_vocab, id_type(encoding)
    texts = prepared.where("learn")
    subwords = count_subwords(texts, size, kind)
    symbol_of = chosen_symbols(subwords)
    pair_of = chosen_pairs(count_pairs(texts, symbol_of, kind))

    every = max(1, int(subwords.sum()) // BLOCK // FIT_WINDOWS)
    lines = fit_windows(texts, kind, every, seed)
    symbols = np.append(symbol_of, [PAD, END]).astype(np.int16)[lines]  # -2 padding, -1 the end
    windows = np.concatenate((symbols[:, :-1], symbols[:, BLOCK + 1:]), axis=1)

    words = materialise(count_words(texts))
    weights = build(
        symbol_of, pair_of, *count_symbols(texts, symbol_of, pair_of, kind), windows, seed)
    return train(texts, weights, int(subwords.sum()), kind), words


# --- Scoring ------------------------------------------------------------------------------------

def hot_words(words: DataFrame, most: int = HOT_WORDS) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes, sorted, and counts of the words with at least the returned count.

    That is as low a count as leaves no more than `most` words.
    """
    steps = (
        words.groupBy(F.floor(F.log2("n") * 8).alias("step"))
        .agg(F.count("*").alias("kinds"), F.min("n").alias("n")).orderBy(F.desc("step")).collect()
    )
    total, bound = 0, 1 << 62
    for row in steps:
        total += row.kinds
        if total > most:
            break
        bound = row.n
    hot = words.where(F.col("n") >= bound).toArrow()
    keys, counts = hot["word"].to_numpy().view(np.uint64), hot["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order], bound


def score(prepared: DataFrame, path: str, weights: Weights, words: DataFrame,
          smoothing: float = SMOOTHING) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    One row per row of the prepared table, repeated rows too. A null text counts as empty and has
    the end alone. Ids may be null; other columns are ignored. score is the model's log10 probability of the
    lower-cased text with its end; base_score is the word model's, in which the end is a word.
    Without training texts no word is known.

    A task looks frequent words up in a table of at most HOT_WORDS; how often the others were seen
    is joined by word. No such word is frequent, so no key of that join is hot.
    """
    totals = words.agg(F.sum("n").alias("tokens"), F.count("*").alias("kinds")).first()
    tokens, kinds = totals.tokens or 0, totals.kinds
    scale = float(np.log10(smoothing * (kinds + 1) + tokens))
    keys, counts, bound = hot_words(words)
    kind = id_type(byte_bpe.load(path))

    def run(batches):
        powers = Powers()
        model, logs = weights.model(), np.log10(counts + smoothing) - scale
        for batch in slices(batches):
            size = len(batch)
            hashes, upto = hashed_words(batch, powers)
            of_text = np.repeat(np.arange(size), np.diff(upto, prepend=0))
            of_text = np.concatenate((of_text, np.arange(size)))
            found, which = np.unique(np.concatenate((hashes, np.full(size, END_WORD))),
                                     return_inverse=True)
            at = np.searchsorted(keys, found)
            at[at == len(keys)] = 0
            hot = keys[at] == found if len(keys) else np.zeros(len(found), bool)
            value = np.where(hot, logs[at] if len(keys) else 0, 0)[which]
            rest = ~hot[which]
            code, times = np.unique(of_text[rest] * len(found) + which[rest], return_counts=True)
            offsets = np.searchsorted(code, np.arange(size + 1) * len(found)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"),
                 pa.array(np.bincount(of_text, minlength=size)),
                 pa.array(np.bincount(of_text[~rest], minlength=size)),
                 pa.array(np.bincount(of_text, value, minlength=size)),
                 pa.array(model.log10_of(*ids_in(batch, kind))),
                 pa.ListArray.from_arrays(offsets, found[code % len(found)].view(np.int64)),
                 pa.ListArray.from_arrays(offsets, times)],
                names=["row", "doc_id", "n_tokens", "n_hot", "hot", "score", "rest", "times"])

    scored = materialise(prepared.select("row", "doc_id", "text", "ids").mapInArrow(
        run, "row long, doc_id long, n_tokens long, n_hot long, hot double, score double, "
             "rest array<long>, times array<long>"))
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select(
        "row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    c: Column = F.coalesce(F.col("n"), F.lit(0))
    rest = (
        rest.join(words.where(F.col("n") < bound), "word", "left")
        .groupBy("row").agg(
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_rest"),
            F.sum(F.col("times") * (F.log10(c + smoothing) - scale)).alias("rest_score"))
    )
    zero = F.lit(0)
    return scored.drop("rest", "times").join(rest, "row", "left").select(
        "doc_id", "n_tokens",
        (F.col("n_hot") + F.coalesce("n_rest", zero)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("hot") + F.coalesce("rest_score", F.lit(0.0))).alias("base_score"), "score")
