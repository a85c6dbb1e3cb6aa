"""Near duplicates by the Jaccard similarity of word n-grams, exactly.

Every text becomes the set of its word n-grams (shingles, as 64-bit hashes). Texts with equal sets
form one class. Two classes are linked when their sets reach the similarity.

1. All shingles are counted. Numbers of shingles travel sorted and packed to the group that counts
   them; what comes back are those that several texts have, so most never travel again.
2. Prefix filter: sets that are similar enough share a shingle among the first few in any common
   order. With rare shingles first such prefixes seldom meet by chance. Prefixes are joined on the
   shingle, with the length and positional filters. A shingle that one text alone has takes its
   place in the order but is never joined.
3. First round: of each shingle's classes the one that meets others most often leads, as the text
   that others are copies of does. Every class is verified against one leader only, the one it
   meets at most places. Copies of one text so cost one check each.
4. Second round: what still lies in different components is compared pair by pair, unless the
   triangle inequality over the checks of the first round rules a pair out.
5. Verification happens once per pair, on the whole sets, after the suffix filter.

A shingle that all copies of a text share never leads to all pairs of the copies, nothing is
capped, and no set or hash of a text goes to the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctrisk.llm.common import materialise, salted_join, slices
from acctrisk.llm.components import components
from acctrisk.llm.hashing import Powers, hashed_words, mixed

WORDS = 5
PERCENT = 80
# Shingles are counted by this many leading bits of their hashes.
ID_BITS = 36
# Occurrences that are counted in one group, on average, and that a task hands on together.
COUNTED, HANDED = 1 << 21, 1 << 20
# Bits of the filter that says which classes have candidates.
FILTER_BITS = 1 << 26
SALTS = 8
# Classes of a shingle that are held in memory together.
GROUP = 64
# Shared shingles of a class by which a pair that meets at many places is looked at once.
HEAD = 16


def sets_of(batch: pa.RecordBatch, words: int, powers: Powers) -> list[np.ndarray]:
    """The sorted shingle hashes of each text of a batch; empty without a word."""
    hashes, upto = hashed_words(batch, powers)
    count = max(len(hashes) - words + 1, 0)
    codes = np.zeros(count, dtype=np.uint64)
    for k in range(words):
        codes = mixed(codes) + hashes[k:k + count]
    codes, out, start = mixed(codes), [], 0
    for end in upto.tolist():
        n = end - start
        if n >= words:
            found = np.sort(codes[start:end - words + 1])
            found = found[np.r_[True, found[1:] != found[:-1]]]
        elif n:
            code = np.full(1, n, dtype=np.uint64)
            for h in hashes[start:end]:
                code = mixed(code) + h
            found = mixed(code)
        else:
            found = np.zeros(0, dtype=np.uint64)
        out.append(found)
        start = end
    return out


def signature(found: np.ndarray) -> int:
    """A signed 64-bit hash of a whole set."""
    value = xxhash.xxh3_64_intdigest(found.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


def prefix_length(n, percent: int):
    """How many of n shingles, in a common order, have to be looked at."""
    return n - (percent * n + 99) // 100 + 1


def needed(total, percent: int):
    """The smallest intersection of two sets with `total` shingles together that are linked."""
    return (percent * total + 99 + percent) // (100 + percent)


# --- Step 1: classes and the counts of shingles -------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte of all of them, compressed."""
    return zlib.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def steps(ids: np.ndarray) -> np.ndarray:
    """Differences of ascending numbers, the first one from zero."""
    return np.diff(ids, prepend=np.zeros(1, ids.dtype))


def ids_of(found: np.ndarray) -> np.ndarray:
    """The numbers by which shingles are counted; they ascend as hashes do."""
    return found >> np.uint64(64 - ID_BITS)


MEASURED = ["doc_id", "n", "sig", "chunk", "bucket", "ids", "owners"]


def measure(docs: DataFrame, words: int, buckets: int) -> DataFrame:
    """Rows of documents (doc_id, n, sig) and rows of shingles to count, in one pass.

    A class is handed on once per task, in chunks of classes. A chunk's rows have chunk, bucket,
    ids (sorted numbers of shingles) and owners (which class of the chunk has each); the row with
    bucket -1 has the classes themselves, signatures as ids and sizes as owners.
    """
    def run(batches):
        powers, seen, waiting = Powers(), set(), []
        chunk = TaskContext.get().partitionId() << 24

        def hand_on():
            sizes = np.array([len(x) for _, x in waiting])
            ids = ids_of(np.concatenate([x for _, x in waiting]))
            order = np.argsort(ids, kind="stable")
            ids, owners = ids[order], np.repeat(np.arange(len(sizes)), sizes)[order]
            of = (ids * np.uint64(buckets)) >> np.uint64(ID_BITS)
            cuts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            ends = np.r_[cuts[1:], len(ids)]
            sigs = np.array([sig for sig, _ in waiting], dtype=np.int64)
            waiting.clear()
            spans = [*zip(cuts.tolist(), ends.tolist(), strict=True)]
            none = pa.nulls(len(spans) + 1, pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, none, pa.array(np.full(len(spans) + 1, chunk)),
                 pa.array([-1, *of[cuts].astype(np.int64).tolist()], pa.int64()),
                 pa.array([packed(sigs.view(np.uint64)),
                           *(packed(steps(ids[i:k])) for i, k in spans)], pa.binary()),
                 pa.array([packed(sizes), *(packed(owners[i:k]) for i, k in spans)], pa.binary())],
                names=MEASURED)

        for batch in slices(batches):
            found = sets_of(batch, words, powers)
            sigs = [signature(x) for x in found]
            for x, sig in zip(found, sigs, strict=True):
                if sig not in seen and len(x):
                    seen.add(sig)
                    waiting.append((sig, x))
            size = len(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in found]),
                 pa.array(sigs, pa.int64()), pa.nulls(size, pa.int64()),
                 pa.nulls(size, pa.int64()), pa.nulls(size, pa.binary()),
                 pa.nulls(size, pa.binary())], names=MEASURED)
            if sum(len(x) for _, x in waiting) > HANDED:
                yield hand_on()
                chunk += 1
        if waiting:
            yield hand_on()

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, sig long, chunk long, bucket long, ids binary, owners binary")


def counted(measured: DataFrame) -> DataFrame:
    """The shingles that several classes have: chunk, ids, owners and levels.

    The level is the logarithm of how many have it, in quarters of a doubling.
    """
    def run(table: pa.Table) -> pa.Table:
        chunks = table["chunk"].to_numpy()
        ids = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in table["ids"]]
        of = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids])
        ids = np.concatenate(ids)
        owners = np.concatenate([unpacked(x.as_py()).astype(np.uint32) for x in table["owners"]])
        order = np.argsort(ids, kind="stable")
        ranked = ids[order]
        first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        times = np.empty(len(ids), dtype=np.int64)
        times[order] = np.repeat(np.diff(np.r_[first, len(ids)]), np.diff(np.r_[first, len(ids)]))
        shared = times > 1
        level = np.floor(4 * np.log2(times[shared]))
        ids, owners, of = ids[shared], owners[shared], of[shared]
        cuts = np.searchsorted(of, np.arange(len(chunks) + 1))
        spans = [(k, i, j) for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
        return pa.table({
            "chunk": pa.array([int(chunks[k]) for k, _, _ in spans], pa.int64()),
            "bucket": pa.array([0] * len(spans), pa.int64()),
            "ids": pa.array([packed(steps(ids[i:j])) for _, i, j in spans], pa.binary()),
            "owners": pa.array([packed(owners[i:j]) for _, i, j in spans], pa.binary()),
            "levels": pa.array([packed(level[i:j]) for _, i, j in spans], pa.binary())})

    return (
        measured.where("bucket >= 0").select("chunk", "bucket", "ids", "owners")
        .groupBy("bucket").applyInArrow(
            run, "chunk long, bucket long, ids binary, owners binary, levels binary")
    )


# --- Step 2: prefixes and their meetings --------------------------------------------------------

def prefixes(measured: DataFrame, percent: int) -> DataFrame:
    """The first shingles of each class in rare-first order: shingle, sig, n, pos.

    Those that the class has alone come first and are left out. Two shingles of a class may have
    one number; as their order is then open, the prefix is longer by as many and places count from
    the lowest they may be.
    """
    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"].to_numpy()
        head = int(np.flatnonzero(bucket == -1)[0])
        sigs = unpacked(table["ids"][head].as_py()).view(np.int64)
        sizes = unpacked(table["owners"][head].as_py()).astype(np.int64)
        rest = np.flatnonzero(bucket >= 0).tolist()
        ids = np.concatenate([np.zeros(0, np.uint64), *(
            np.cumsum(unpacked(table["ids"][k].as_py()), dtype=np.uint64) for k in rest)])
        owner, level = (np.concatenate([np.zeros(0, np.int64), *(
            unpacked(table[c][k].as_py()).astype(np.int64) for k in rest)])
            for c in ("owners", "levels"))
        order = np.lexsort((ids, level, owner))
        ids, owner = ids[order].astype(np.int64), owner[order]
        starts = np.searchsorted(owner, np.arange(len(sizes) + 1))
        alone = sizes - np.diff(starts)
        twice = np.zeros(len(ids), dtype=bool)
        twice[1:] = (ids[1:] == ids[:-1]) & (owner[1:] == owner[:-1])
        open_ = np.bincount(owner[twice], minlength=len(sizes))
        place = alone[owner] + np.arange(len(ids)) - starts[owner]
        kept = place < prefix_length(sizes, percent)[owner] + open_[owner]
        owner = owner[kept]
        return pa.table({"shingle": pa.array(ids[kept]), "sig": pa.array(sigs[owner]),
                         "n": pa.array(sizes[owner]),
                         "pos": pa.array(np.maximum(place[kept] - open_[owner], 0))})

    heads = measured.where("bucket = -1").select(
        "chunk", "bucket", "ids", "owners", F.lit(None).cast("binary").alias("levels"))
    return (
        heads.unionByName(counted(measured)).groupBy("chunk")
        .applyInArrow(run, "shingle long, sig long, n long, pos long")
    )


def with_partner(x: np.ndarray, group: np.ndarray, most: int, percent: int) -> np.ndarray:
    """Whether a row passes the filters with another one of its group.

    group: ascending numbers, each at most `most` times.
    """
    ok = np.zeros(x.shape[1], dtype=bool)
    n, left = x[2], x[2] - x[3]
    for d in range(1, min(most, x.shape[1])):
        same = np.flatnonzero(group[d:] == group[:-d])
        if not len(same):
            break
        other = same + d
        link = ((percent * n[other] <= 100 * n[same])
                & ((100 + percent) * np.minimum(left[same], left[other])
                   >= percent * (n[same] + n[other])))
        ok[same[link]] = ok[other[link]] = True
    return ok


def meetings(entries: DataFrame, percent: int) -> DataFrame:
    """The prefix entries whose shingle two classes or more have.

    In groups of up to GROUP classes, those that pass the length and positional filters with no
    other class are left out at once. Entries are sorted by shingle, size and class for one pass
    that remembers the last group, or one row of it where it is larger, so a frequent shingle
    needs no memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = np.zeros((4, 0), dtype=np.int64), False
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy() for c in names])
            x = np.concatenate((held, x), axis=1)
            new = np.ones(x.shape[1], dtype=bool)
            new[1:] = (x[:2, 1:] != x[:2, :-1]).any(0)  # equal entries come from several tasks
            x = x[:, new]
            last = int(np.searchsorted(x[0], x[0, -1]))
            yield from out(x[:, :last], large)
            large = large and not last
            held = x[:, last:]
            if held.shape[1] > GROUP:
                yield from rows(held[:, :-1])
                held, large = held[:, -1:], True
        yield from out(held, large)

    def out(x, large):
        if not x.shape[1]:
            return
        group = np.cumsum(np.r_[True, x[0, 1:] != x[0, :-1]]) - 1
        size = np.bincount(group)
        all_ = size[group] > GROUP
        if large:  # the first group goes on from rows handed on before
            all_ |= group == 0
        yield from rows(x[:, with_partner(x, group, int(size.max()), percent) | all_])

    def rows(x):
        if x.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in x], names=names)

    names = ["shingle", "sig", "n", "pos"]
    return (
        entries.repartition("shingle").sortWithinPartitions("shingle", "n", "sig")
        .mapInArrow(run, ", ".join(f"{c} long" for c in names))
    )


def _may_link(n: str, pos: str, other_n: str, other_pos: str, percent: int) -> Column:
    """Length and positional filters for a pair that meets at the given places.

    At the first shingle that both have, what is left of the shorter rest has to suffice.
    """
    a, b = F.col(n), F.col(other_n)
    rest = F.least(a - F.col(pos), b - F.col(other_pos))  # this shingle and those after it
    return ((percent * F.greatest(a, b) <= 100 * F.least(a, b))
            & ((100 + percent) * rest >= percent * (a + b)))


# --- Verification -------------------------------------------------------------------------------

def whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """sig and shingles (sorted, little-endian) of the classes in `wanted`, and of a few others.

    A bit table of fixed size tells tasks which classes they have to hand on.
    """
    place = F.col("sig").bitwiseAND(FILTER_BITS - 1) + 1
    filled = wanted.select(F.bitmap_bucket_number(place).alias("bucket"),
                           F.bitmap_bit_position(place).alias("bit"))
    table = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in filled.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bits = np.frombuffer(bytes(row.bits), dtype=np.uint8)
        table[(row.bucket - 1) * len(bits):row.bucket * len(bits)] = bits

    def run(batches):
        powers, seen = Powers(), set()
        for batch in slices(batches):
            sigs, sets = [], []
            for found in sets_of(batch, words, powers):
                sig = signature(found)
                at = sig & (FILTER_BITS - 1)
                if len(found) and table[at >> 3] >> (at & 7) & 1 and sig not in seen:
                    seen.add(sig)
                    sigs.append(sig)
                    sets.append(found.tobytes())
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sigs, pa.int64()), pa.array(sets, pa.binary())],
                    names=["sig", "shingles"])

    handed = docs.select("text").mapInArrow(run, "sig long, shingles binary")
    return handed.groupBy("sig").agg(F.first("shingles").alias("shingles"))


_PIVOTS = np.arange(1, 32, dtype=np.uint64) << np.uint64(59)


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """Suffix filter: at least so many shingles are in one of two sets only.

    Both sets are cut at the same values; what one has more in a part has no partner there.
    """
    cuts = [np.diff(np.searchsorted(x, _PIVOTS), prepend=0, append=len(x)) for x in (a, b)]
    return int(np.abs(cuts[0] - cuts[1]).sum())


def verify(pairs: DataFrame, sets: DataFrame, percent: int, suffix: bool) -> DataFrame:
    """a, b, shared and total (sizes of both sets) of every pair, counted on the whole sets.

    With `suffix`, pairs that the suffix filter rules out are left out.
    """
    def run(batches):
        for batch in slices(batches, "b_set"):
            kept, shared, total = [], [], []
            for i, (p, q) in enumerate(zip(batch.column("a_set").to_pylist(),
                                           batch.column("b_set").to_pylist(), strict=True)):
                x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(x) + len(y)
                if suffix and apart(x, y) > both - 2 * needed(both, percent):
                    continue
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                kept.append(i)
                shared.append(int((x[at] == y).sum()))
                total.append(both)
            if kept:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(pa.array(kept)), batch.column("b").take(pa.array(kept)),
                     pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                    names=["a", "b", "shared", "total"])

    with_b = pairs.join(sets.select(F.col("sig").alias("b"), F.col("shingles").alias("b_set")), "b")
    with_a = with_b.join(
        sets.select(F.col("sig").alias("a"), F.col("shingles").alias("a_set")), "a")
    return with_a.select("a", "b", "a_set", "b_set").mapInArrow(
        run, "a long, b long, shared long, total long")


# --- The join -----------------------------------------------------------------------------------

@dataclass
class Joined:
    """documents: doc_id, n_shingles, component_id, and sig, the class; links: a, b (classes),
    shared and total, enough of them to connect every component."""

    documents: DataFrame
    links: DataFrame


def first_round(met: DataFrame, percent: int) -> DataFrame:
    """One pair per class, with the leader that it meets at most places.

    A shingle's leader is the class that meets others at most places in all. Ties go to the
    leader that meets more and then to the smaller class.
    """
    weights = met.groupBy("sig").agg(F.count("*").alias("weight"))
    rows = met.join(weights, "sig")
    leaders = rows.groupBy("shingle").agg(
        F.max(F.struct("weight", -F.col("sig"), "sig", "n", "pos")).alias("l")).select(
        "shingle", F.col("l.sig").alias("leader"), F.col("l.n").alias("leader_n"),
        F.col("l.pos").alias("leader_pos"), F.col("l.weight").alias("leader_weight"))
    return (
        salted_join(rows.drop("weight"), leaders, ["shingle"], "sig", SALTS, "inner")
        .where((F.col("sig") != F.col("leader"))
               & _may_link("n", "pos", "leader_n", "leader_pos", percent))
        .groupBy("sig", "leader").agg(F.count("*").alias("times"),
                                      F.first("leader_weight").alias("weight"))
        .groupBy("sig").agg(F.max(F.struct(
            "times", "weight", -F.col("leader"), "leader")).alias("best"))
        .select(F.col("best.leader").alias("a"), F.col("sig").alias("b"))
    )


def second_round(met: DataFrame, checked: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """The pairs of different components that filters and triangle inequality leave open.

    In a shingle's classes the most frequent component is only compared with the others, never
    within itself. A pair is taken where it first meets; only pairs that meet late in a prefix are
    taken at several places and made distinct. Jaccard distances obey the triangle inequality: two
    classes whose distances to the same leader differ by more than the largest distance of a link cannot be linked.
    """
    known = checked.select(
        F.col("b").alias("sig"), F.col("a").alias("led_by"),
        (1 - F.col("shared") / (F.col("total") - F.col("shared"))).alias("far"))
    heads = met.groupBy("sig").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("pos", "shingle"))), 1, HEAD)["shingle"]
        .alias("head"))
    rows = (
        met.join(heads, "sig")
        .join(roots.withColumnRenamed("node", "sig"), "sig", "left").join(known, "sig", "left")
        .select("shingle", "sig", "n", "pos", "head", F.coalesce("root", "sig").alias("root"),
                "led_by", F.coalesce("led_by", "sig").alias("anchor"),
                F.coalesce("far", F.lit(0.0)).alias("far"))
    )
    kinds = rows.groupBy("shingle", "root").agg(F.count("*").alias("times"))
    mixed = (
        kinds.groupBy("shingle").agg(F.max(F.struct("times", "root")).alias("main"),
                                     F.count("*").alias("kinds"))
        .where("kinds > 1").select("shingle", F.col("main.root").alias("main"))
    )
    rows = materialise(rows.join(mixed, "shingle"))
    one = rows.where("root <> main").select("shingle", *(
        F.col(c).alias(f"one_{c}")
        for c in ("sig", "n", "pos", "head", "root", "led_by", "anchor", "far")))
    both = F.array_intersect("head", "one_head")
    ruled_out = ((F.col("anchor") == F.col("one_anchor"))
                 & (F.abs(F.col("far") - F.col("one_far")) > 1 - percent / 100 + 1e-9))
    return (
        rows.join(one, "shingle").where(
            (F.col("root") != F.col("one_root"))
            & ((F.col("root") == F.col("main")) | (F.col("one_root") < F.col("root")))
            & _may_link("n", "pos", "one_n", "one_pos", percent) & ~ruled_out
            & ((F.size(both) == 0) | (F.get(both, F.lit(0)) == F.col("shingle")))
            & ~F.coalesce(F.col("led_by") == F.col("one_sig"), F.lit(False))
            & ~F.coalesce(F.col("one_led_by") == F.col("sig"), F.lit(False)))
        .select(F.least("sig", "one_sig").alias("a"), F.greatest("sig", "one_sig").alias("b"))
        .distinct()
    )


def join(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> Joined:
    """All documents with the components of those whose shingle sets are similar.

    Two documents are linked when 100 * intersection >= percent * union. A text with fewer words
    than a shingle has one shingle, the whole sequence. Null, empty and blank texts have no
    shingles, are linked with nothing and are components of their own. component_id is the
    smallest doc_id of the component; null ids are passed over. Repeated rows each give a row;
    columns other than doc_id and text are ignored; an empty table gives no rows.

    Shingles and sets are told apart by 64-bit hashes. Intermediate tables are written to the
    shared folder, so a lost executor costs the tasks that ran on it and no more.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    measured = materialise(measure(docs, words, max(1, chars // (4 * COUNTED))))
    classes = measured.where("chunk is null").select("doc_id", "n", "sig")
    met = materialise(meetings(prefixes(measured, percent), percent))
    sets = materialise(whole_sets(docs, met.select("sig"), words))

    similar = F.col("shared") * (100 + percent) >= percent * F.col("total")
    checked = materialise(verify(first_round(met, percent), sets, percent, suffix=False))
    links = checked.where(similar)
    roots = components(links)
    more = verify(second_round(met, checked, roots, percent), sets, percent, suffix=True)
    more = materialise(more.where(similar))
    links = links.unionByName(more)
    roots = materialise(components(
        more.select("a", "b").unionByName(
            roots.select(F.col("root").alias("a"), F.col("node").alias("b")))))

    kinds = classes.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("first_id"))
    kinds = kinds.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig"))
    least = kinds.groupBy("root").agg(F.min("first_id").alias("component_id"))
    kinds = salted_join(kinds, least, ["root"], "sig", SALTS).select("sig", "component_id")
    some = salted_join(classes.where("n > 0"), kinds, ["sig"], "doc_id", SALTS)
    none = classes.where("n = 0").withColumn("component_id", F.col("doc_id"))
    documents = some.select("doc_id", "n", "sig", "component_id").unionByName(none)
    return Joined(documents.withColumnRenamed("n", "n_shingles"), links)
