"""Repair of the structure of dialogues: the cheapest edits, by rank-convergence parallel Viterbi.

A dialogue should be an optional system turn and then pairs of user and assistant. A turn can be
kept, given another role or deleted, and an empty turn can be inserted. The cheapest edits are a
shortest path over turns and four states (nothing yet, after the system, a user, an assistant).

1. Turns are put in order by a range sort and numbered. A dialogue is cut into chunks of at most
   `CHUNK` turns, so one dialogue may span any number of tasks. Repeated turns are found by hashes.
2. Each chunk computes the costs from its turns to its end backwards, all chunks at once, from a
   speculative vector of costs at the end: one number per state.
3. A pass over the chunks of each dialogue, last to first, holds the vectors against those of the
   chunk that follows. Only differences between states matter. A chunk whose end differs by more
   than a constant is run again in a fix-up pass, up to the turn from which its vectors differ from
   the old ones by a constant alone. Passes go on until every chunk has met its true end. There are
   few vectors of differences, and runs are remembered, so passes do not grow with the chunks.
4. The stitched costs tell at every turn which edits lie on a cheapest path; the trace takes the
   first letter in ASCII order. Chunks are traced from all states at once; a pass first to last
   picks the state that each is entered in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrisk.llm.common import materialise, salted_join
from acctrisk.llm.lines import WHITE, hashed

# Turns of a chunk at most, a power of two.
CHUNK = 4096
# Characters by which turns of one place, number and role are dealt over tasks in order.
HEAD = 256
SALTS = 16

# Kinds of role initials, and what stands in a turn's way.
KINDS = "sua"
OTHER, CUT, BLANK, REPEATED = 3, 4, 8, 16
LEGAL = {(0, 1), (1, 2), (2, 1)}
# States, and the one role that each lets a turn be given or inserted with.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
KEPT = {(0, NOTHING): SYSTEM, (1, NOTHING): USER, (1, SYSTEM): USER, (1, ASSISTANT): USER,
        (2, USER): ASSISTANT}
LETTER = {USER: "u", ASSISTANT: "a"}
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
# Costs after the last turn, and the turns that are then inserted.
FINAL = (0, 2 * INSERT, INSERT, 0)
CLOSING = ("", "IuIa", "Ia", "")

Costs = tuple[int, ...]


# --- The path through one chunk -----------------------------------------------------------------

@lru_cache(maxsize=None)
def step(code: int, after: Costs) -> tuple[Costs, int, tuple[tuple[str, int], ...]]:
    """The costs before a turn from those after it, less their least, that least, and the moves.

    A move, one per state, is the first string of edits of a cheapest way past the turn and the
    state it leads to. There are few codes and differences of costs, so all results are kept.
    """
    late = TRUNCATED if code & CUT else 0
    ways: list[list[tuple[int, str, int]]] = []
    for p in range(4):
        ways.append([(DELETE + after[p], "D", p)])
        if not code & (BLANK | REPEATED):
            if (code & 3, p) in KEPT:
                q = KEPT[code & 3, p]
                ways[p].append((late + after[q], "K", q))
            q = NEXT[p]
            ways[p].append((REROLE + late + after[q], "R" + LETTER[q], q))
    own = [min(way[0] for way in some) for some in ways]
    before = [min(own[p], INSERT + own[NEXT[p]], 2 * INSERT + own[NEXT[NEXT[p]]])
              for p in range(4)]
    moves = []
    for p in range(4):
        edits, at, passed = "", p, False
        while not passed:
            q = NEXT[at]
            some = [*ways[at], (INSERT + before[q], "I" + LETTER[q], q)]
            _, letter, to = min((x for x in some if x[0] == before[at]), key=lambda x: x[1])
            edits, at, passed = edits + letter, to, letter[0] != "I"
        moves.append((edits, at))
    least = min(before)
    return tuple(x - least for x in before), least, tuple(moves)


def run(codes: bytes, end: Costs) -> tuple[Costs, int]:
    """The costs at a chunk's start for those at its end, and what was taken off."""
    total = 0
    for code in reversed(codes):
        end, least, _ = step(code, end)
        total += least
    return end, total


def run_again(codes: bytes, old: tuple[Costs, Costs, int], end: Costs) -> tuple[Costs, int]:
    """The same from another end, up to where the costs differ from the old run's by a constant."""
    old_end, old_start, old_total = old
    was = now = 0
    for code in reversed(codes):
        if end == old_end:
            return old_start, old_total - was + now
        old_end, x, _ = step(code, old_end)
        end, y, _ = step(code, end)
        was, now = was + x, now + y
    return end, now


def moves_of(codes: bytes, end: Costs) -> list[tuple[tuple[str, int], ...]]:
    """The moves of every turn of a chunk, in order."""
    out = []
    for code in reversed(codes):
        end, _, moves = step(code, end)
        out.append(moves)
    return out[::-1]


def faults(codes: bytes) -> tuple[int, int, int, int]:
    """How many turns are blank, repeated and truncated, and how many neighbours do not fit."""
    return (sum(1 for c in codes if c & BLANK), sum(1 for c in codes if c & REPEATED),
            sum(1 for c in codes if c & CUT),
            sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:])))


# --- Turns in order -----------------------------------------------------------------------------

def code_of(role: Column, text: Column) -> Column:
    """A turn's code; repeated turns are marked later."""
    kind = F.lit(OTHER)
    for i, initial in enumerate(KINDS):
        kind = F.when(F.left(role, F.lit(1)) == initial, F.lit(i)).otherwise(kind)
    said = F.rtrim(text, F.lit(WHITE))
    fault = F.when(said == "", F.lit(BLANK)).when(
        F.right(said, F.lit(1)).isin(".", "!", "?"), F.lit(0)).otherwise(F.lit(CUT))
    return (kind + fault).cast("int")


def in_order(turns: DataFrame) -> DataFrame:
    """Turns with place (ascending in the order of dialogue, turn, role and text), code and hash.

    Equal rows are dealt over tasks by a number of their own, as their order does not matter.
    """
    blank = F.lit(" ")
    known = turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", F.left("text", F.lit(HEAD)), F.xxhash64("text"), "row"]
    a, b = hashed(F.col("conv_id").cast("string"), F.col("role"), F.col("text"))
    return (
        known.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("place"),
                code_of(F.col("role"), F.col("text")).alias("code"), a.alias("a"), b.alias("b"))
    )


def chunks_of(rows: DataFrame) -> DataFrame:
    """conv_id, first (the place of the chunk's first turn) and codes, one row per chunk.

    The turns of a dialogue that one task has in one block of places follow each other.
    """
    firsts = (
        rows.groupBy("a", "b").agg(F.min("place").alias("seen"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    repeated = salted_join(
        rows.where(F.col("code") < BLANK).select("conv_id", "place", "a", "b"), firsts, ["a", "b"],
        "place", SALTS, "inner").where("place <> seen")
    marks = rows.select("conv_id", "place", "code").unionAll(
        repeated.select("conv_id", "place", F.lit(REPEATED).alias("code")))
    found = F.sort_array(F.collect_list(F.struct("place", "code")))
    chunks = marks.groupBy("conv_id", F.shiftright("place", CHUNK.bit_length() - 1).alias("block"))
    return chunks.agg(found.alias("turns")).select(
        "conv_id", F.col("turns")[0]["place"].alias("first"),
        F.col("turns.place").alias("places"), F.col("turns.code").alias("codes"))


# --- Passes over chunks -------------------------------------------------------------------------

def _fields(*named: tuple[str, str], conv: T.DataType) -> str:
    return ", ".join(f"{n} {kind}" for n, kind in (("conv_id", conv.simpleString()), *named))


_RUN = "struct<end:array<int>,start:array<int>,total:bigint>"
_SOLVED = (("first", "bigint"), ("codes", "binary"), ("runs", f"array<{_RUN}>"))
_STITCHED = (("first", "bigint"), ("end", "array<int>"), ("known", "boolean"),
             ("last", "boolean"), ("cost", "bigint"))
_TRACED = (("first", "bigint"), ("end", "array<int>"), ("last", "boolean"), ("cost", "bigint"),
           ("exits", "array<int>"), ("head", "int"), ("tail", "int"), ("blank", "bigint"),
           ("duplicate", "bigint"), ("truncated", "bigint"), ("illegal", "bigint"))
_CHAINED = (("first", "bigint"), ("end", "array<int>"), ("entry", "int"), ("last", "boolean"),
            ("cost", "bigint"), ("blank", "bigint"), ("duplicate", "bigint"),
            ("truncated", "bigint"), ("illegal", "bigint"))
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(),
          "array<int>": pa.list_(pa.int32()),
          f"array<{_RUN}>": pa.list_(pa.struct([
              ("end", pa.list_(pa.int32())), ("start", pa.list_(pa.int32())),
              ("total", pa.int64())]))}


def _batch(conv: pa.Array, fields, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in fields)
    return pa.RecordBatch.from_arrays(
        [conv, *(pa.array(list(values), _ARROW[kind])
                 for values, (_, kind) in zip(columns, fields, strict=True))],
        names=["conv_id", *(name for name, _ in fields)])


def _tuples(run: dict) -> tuple[Costs, Costs, int]:
    return tuple(run["end"]), tuple(run["start"]), run["total"]


def speculate(chunks: DataFrame, conv: T.DataType) -> DataFrame:
    """Every chunk run from the costs after a last turn, which most chunks end with."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for first, places, found in zip(
                    *(batch.column(c).to_pylist() for c in ("first", "places", "codes")),
                    strict=True):
                codes = bytearray(places[-1] - first + 1)
                for place, code in zip(places, found, strict=True):
                    codes[place - first] |= code & REPEATED or code
                # a repeated turn is not truncated as well: its first fault counts
                codes = bytes(c & ~CUT if c & REPEATED else c for c in codes)
                start, total = run(codes, FINAL)
                rows.append((first, codes, [{"end": FINAL, "start": start, "total": total}]))
            yield _batch(batch.column("conv_id"), _SOLVED, rows)

    return chunks.mapInArrow(solve, _fields(*_SOLVED, conv=conv))


def stitch(solved: DataFrame, conv: T.DataType) -> DataFrame:
    """The costs at the end of each chunk, last to first, and whether the chunk was run from them.

    Where it was not, the differences of its first run stand in until the next pass. `cost` is
    that of all edits from the chunk on, `last` tells the last chunk of a dialogue.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, end, total = object(), FINAL, 0
        for batch in batches:
            rows = []
            for of, first, runs in zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "first", "runs")), strict=True):
                last = of != current
                if last:
                    current, end, total = of, FINAL, 0
                known = {e: (s, t) for e, s, t in map(_tuples, runs)}
                start, more = known.get(end) or known[FINAL]
                total += more
                rows.append((first, end, end in known, last, start[NOTHING] + total))
                end = start
            yield _batch(batch.column("conv_id"), _STITCHED, rows)

    spread = solved.select("conv_id", "first", "runs").repartition("conv_id")
    return spread.sortWithinPartitions("conv_id", F.desc("first")).mapInArrow(
        scan, _fields(*_STITCHED, conv=conv))


def fix_up(solved: DataFrame, stitched: DataFrame, conv: T.DataType) -> DataFrame:
    """Chunks that met an end of their own are run again from it."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for first, codes, runs, end, known in zip(*(batch.column(c).to_pylist() for c in (
                    "first", "codes", "runs", "end", "known")), strict=True):
                if not known:
                    start, total = run_again(codes, _tuples(runs[0]), tuple(end))
                    runs = [*runs, {"end": end, "start": start, "total": total}]
                rows.append((first, codes, runs))
            yield _batch(batch.column("conv_id"), _SOLVED, rows)

    met = stitched.select("first", "end", "known")
    return solved.join(met, "first").select("conv_id", "first", "codes", "runs", "end", "known") \
        .mapInArrow(solve, _fields(*_SOLVED, conv=conv))


def trace_all(solved: DataFrame, stitched: DataFrame, conv: T.DataType) -> DataFrame:
    """Where a trace through each chunk leads from every state, and the chunk's faults."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for first, codes, end, last, cost in zip(*(batch.column(c).to_pylist() for c in (
                    "first", "codes", "end", "last", "cost")), strict=True):
                exits = list(range(4))
                for moves in moves_of(codes, tuple(end)):
                    exits = [moves[p][1] for p in exits]
                rows.append((first, end, last, cost, exits, codes[0] & 3, codes[-1] & 3,
                             *faults(codes)))
            yield _batch(batch.column("conv_id"), _TRACED, rows)

    met = stitched.select("first", "end", "last", "cost")
    return solved.select("conv_id", "first", "codes").join(met, "first").select(
        "conv_id", "first", "codes", "end", "last", "cost").mapInArrow(
        solve, _fields(*_TRACED, conv=conv))


def chain(traced: DataFrame, conv: T.DataType) -> DataFrame:
    """The state in which each chunk is entered, first to last.

    Cost is given once per dialogue, with its first chunk; a pair of neighbours that a cut parts
    counts with the later chunk.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, tail = object(), NOTHING, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                opens = r["conv_id"] != current
                if opens:
                    current, state = r["conv_id"], NOTHING
                parted = not opens and (tail, r["head"]) not in LEGAL
                rows.append((r["first"], r["end"], state, r["last"], r["cost"] if opens else 0,
                             r["blank"], r["duplicate"], r["truncated"], r["illegal"] + parted))
                state, tail = r["exits"][state], r["tail"]
            yield _batch(batch.column("conv_id"), _CHAINED, rows)

    spread = traced.repartition("conv_id").sortWithinPartitions("conv_id", "first")
    return spread.mapInArrow(scan, _fields(*_CHAINED, conv=conv))


def edits_of(solved: DataFrame, chained: DataFrame) -> DataFrame:
    """place and edits of every turn: letters, those of a new role with its initial."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, edits = [], []
            for first, codes, end, entry, last in zip(*(batch.column(c).to_pylist() for c in (
                    "first", "codes", "end", "entry", "last")), strict=True):
                for i, moves in enumerate(moves_of(codes, tuple(end))):
                    edit, entry = moves[entry]
                    places.append(first + i)
                    edits.append(edit)
                if last:
                    edits[-1] += CLOSING[entry]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(edits, pa.string())],
                names=["place", "edits"])

    return solved.select("first", "codes").join(
        chained.select("first", "end", "entry", "last"), "first").mapInArrow(
        solve, "place long, edits string")


# --- The operator -------------------------------------------------------------------------------

@dataclass(frozen=True)
class Repaired:
    """conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost.

    turns: conv_id, place and step (the order within a dialogue), turn, edit (K, R, D or I), role
    and text after the edit; deleted turns are listed as they were, inserted ones have no `turn`.
    """

    conversations: DataFrame
    turns: DataFrame


def repair(turns: DataFrame) -> Repaired:
    """The cheapest edits that make every dialogue an optional system turn and user-assistant pairs.

    turns: conv_id, turn, role and text; other columns are ignored. A role counts by its first
    letter. Keeping a turn costs 0, giving it the role user or assistant 2, deleting it 3 and
    inserting an empty turn 2; a truncated turn that stays costs 1 more. Blank turns (without
    anything but white space) and those whose role and text the dialogue had before are deleted.
    Of equally cheap edits the first string of letters in ASCII order is taken.

    A null role or text counts as one space; rows without conv_id are one dialogue. Turns come in
    the order of turn (null first), role and text (those alike in 256 characters by a hash), and
    equal rows are copies, of which the first is no duplicate. No rows give no rows.
    """
    conv = turns.schema["conv_id"].dataType
    rows = materialise(in_order(turns))
    solved = materialise(speculate(chunks_of(rows), conv))
    stitched = materialise(stitch(solved, conv))
    while not stitched.where("NOT known").isEmpty():
        solved = materialise(fix_up(solved, stitched, conv))
        stitched = materialise(stitch(solved, conv))
    chained = materialise(chain(trace_all(solved, stitched, conv), conv))

    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    found = chained.groupBy(F.struct("conv_id").alias("key")).agg(
        *(F.sum(c).alias(c) for c in counts))
    span = rows.groupBy(F.struct("conv_id").alias("key")).agg(
        F.min("turn").cast("decimal(20,0)").alias("low"),
        F.max("turn").cast("decimal(20,0)").alias("high"), F.count_distinct("turn").alias("n"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0))
    conversations = found.join(span, "key").select(
        "key.conv_id", gaps.try_cast("bigint").alias("gaps"), *counts)

    edited = rows.select("conv_id", "turn", "role", "text", "place").join(
        edits_of(solved, chained), "place").select(
        "*", F.posexplode(F.regexp_extract_all("edits", F.lit("([DIKR][ua]?)"), F.lit(1)))
        .alias("step", "made"))
    to = F.substr("made", F.lit(2))
    inserted = F.col("made").startswith("I")
    return Repaired(conversations, edited.select(
        "conv_id", "place", "step", F.when(~inserted, F.col("turn")).alias("turn"),
        F.left("made", F.lit(1)).alias("edit"),
        F.when(to == "u", "user").when(to == "a", "assistant").otherwise(F.col("role"))
        .alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text")))


def digests(turns: DataFrame) -> DataFrame:
    """Per dialogue of repaired turns its audit, the letters of all edits, and repaired_sha256.

    The hash runs over `role:text` of the turns that stay, with line feeds between them. It reads
    the turns of a dialogue in order as they stream by and holds none of them.
    """
    conv = turns.schema["conv_id"].dataType

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, letters, digest, any_kept = None, None, None, False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [current, pa.array(["".join(letters)]), pa.array([digest.hexdigest()])],
                names=["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            ids = batch.column("conv_id")
            for i, (of, edit, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "conv_id", "edit", "role", "text")), strict=True)):
                if letters is None or of != current[0].as_py():
                    if letters is not None:
                        yield done()
                    current, letters, any_kept = ids.slice(i, 1), [], False
                    digest = hashlib.sha256()
                letters.append(edit)
                if edit != "D":
                    digest.update(("\n" * any_kept + f"{role}:{text}").encode())
                    any_kept = True
        if letters is not None:
            yield done()

    text = F.when(F.col("edit") != "D", F.col("text")).alias("text")
    return (
        turns.select("conv_id", "place", "step", "edit", "role", text).repartition("conv_id")
        .sortWithinPartitions("conv_id", "place", "step").drop("place", "step")
        .mapInArrow(read, _fields(("audit", "string"), ("repaired_sha256", "string"), conv=conv))
    )


# --- Damage -------------------------------------------------------------------------------------

def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text with known faults, by crc32 of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 takes out `.`, `!` and `?`, 3 repeats it, 4 makes it the
    user's. Nulls count as one space.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    times = F.sequence(F.lit(1), F.when(F.col("by") == 3, 2).otherwise(1))
    return turns.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("by"),
    ).where("by <> 0").select(
        "conv_id", "turn", F.when(F.col("by") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("by") == 1, "").when(F.col("by") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"), F.explode(times).alias("copy")).drop("copy")
