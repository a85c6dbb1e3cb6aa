"""Packing of token sequences: first-fit decreasing in randomised groups of documents.

Every document's ids are cut into pieces of the full length and a rest. The pieces of a group of
documents are put, longest first, into the first sequence with room. A tournament tree over the
free places of the sequences finds that sequence in logarithmic time: each inner node holds the
largest free place below it. Groups are independent, so packing needs one shuffle of small piece
descriptions and no order among tasks.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctrisk.llm import byte_bpe
from acctrisk.llm.common import slices, texts_of

CAPACITY = 1024
GROUP_DOCS = 4096
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, copy long"
PACKED = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Bins:
    """Sequences with free places; `place` finds the first one with room for a length."""

    def __init__(self, capacity: int, most: int):
        self.capacity = capacity
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset in it."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < length:
                node += 1
        at, offset = node - self.leaves, self.capacity - best[node]
        best[node] -= length
        while node > 1:
            node >>= 1
            left, right = best[2 * node], best[2 * node + 1]
            best[node] = left if left >= right else right
        return at, offset


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; pieces of equal length keep their order.

    Pieces of the full length come first and fill a sequence each, so they need no search.
    """
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    full = int((lengths == capacity).sum())
    sequence[order[:full]] = np.arange(full)
    bins = Bins(capacity, max(1, len(lengths) - full))
    for i in order[full:].tolist():
        at, offset[i] = bins.place(int(lengths[i]))
        sequence[i] = full + at
    return sequence, offset


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False,
           added: bool = False) -> DataFrame:
    """Every document's ids, the end id included, cut into pieces of at most `capacity`.

    `copy` numbers equal rows of a task; the set of numbers does not depend on the order of rows,
    so a task that runs again gives the same pieces.
    """
    def run(batches):
        encoding, seen = byte_bpe.load(path), {}
        special = byte_bpe.added_tokens(path) if added else None
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch),
                                    strict=True):
                ids = np.append(byte_bpe.encode_text(encoding, text, special), END_ID).astype("<u4")
                key = (doc_id, zlib.crc32(ids.tobytes()))
                seen[key] = copy = seen.get(key, -1) + 1
                for start in range(0, len(ids), capacity):
                    part = ids[start:start + capacity].tobytes()
                    out.append((doc_id, start, len(part) // 4, zlib.crc32(part), len(ids), copy)
                               + ((part,) if with_ids else ()))
            columns = [pa.array(x, pa.int64()) for x in list(zip(*out, strict=True))[:6]]
            if with_ids:
                columns.append(pa.array([x[6] for x in out], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "copy"] + ["ids"] * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, PIECES + ", ids binary" * with_ids)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         group_docs: int = GROUP_DOCS, seed: int = 0, with_ids: bool = False,
         added: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with `with_ids`, the
    piece's ids (little-endian unsigned 32-bit). A null text counts as empty and has the end id
    only. Repeated rows are packed each for itself; ids may be null. Other columns are ignored; an
    empty table gives no rows. With `added`, added tokens of the vocabulary that stand in a text
    get their ids, as the tokenizers library does by default; else they are ordinary text.

    Documents fall into groups of about `group_docs` by a seeded hash, copies of a row into
    different groups, so groups stay even whatever the ids are. The vocabulary file has to be at
    `path` on every executor. Its merges are run by the tiktoken library, which gives the ids of
    the tokenizers library several times faster (the tests compare both).
    """
    path = path or public_tokenizers.path(VOCABULARY)
    groups = max(1, -(-docs.select("doc_id").count() // group_docs))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("copy", "ascending"),
                               ("ids_crc32", "ascending"), ("start", "ascending")])
        sequence, offset = first_fit_decreasing(table["length"].to_numpy(), capacity)
        base = table["part"][0].as_py() << 32
        kept = table.drop_columns(["copy", "part", "ids"] if with_ids else ["copy", "part"])
        kept = kept.append_column("sequence_id", pa.array(base + sequence))
        kept = kept.append_column("offset", pa.array(offset))
        return kept.append_column("ids", table["ids"]) if with_ids else kept

    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "doc_tokens", "copy"), F.lit(groups))
    return (
        pieces(docs, path, capacity, with_ids, added).withColumn("part", part)
        .groupBy("part").applyInArrow(run, PACKED + ", ids binary" * with_ids)
    )
