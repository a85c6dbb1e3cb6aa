"""Byte-level BPE encoding and decoding with a local rank file.

Texts are encoded by the tiktoken library. A long text is first cut at safe boundaries: places
where a character that is not white space meets white space. No match of the splitting pattern
spans such a place and no look-ahead reaches over it, so the pieces encode to exactly the ids of
the whole text, while the library never holds more than a piece.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from acctrisk.llm.common import slices, texts_of

# ASCII only, so that white space means the same to every regular expression engine.
SAFE_BOUNDARY = re.compile(r"(?<=[!-~])(?=[ \t\n\r])")
LONG_TEXT = 1 << 16

# White space as the tokenizer has it, which Python's \s has more of.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# How the pattern ends, with a look-ahead, and the places where that ends a match: before the last
# white space of a run that something follows.
RUNS, PLAIN_RUNS = r"|\s+(?!\S)|\s+", r"|\s+"
RUN_END = re.compile(f"[{WHITE}](?=[{WHITE}][^{WHITE}])")
# Characters per such place from which on it pays to cut a text there.
FEW_RUNS = 256

TOKENS = "doc_id long, n_tokens long, ids binary"


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files of byte-level tokenizers.

    Printable Latin-1 characters stand for themselves, the others for characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


# A special token that is never allowed, so it is ordinary text where it occurs. Without any, the
# library tries the empty one at every character of a text.
NEVER = {"\0<never>\0": 0}


def load(path: str, pattern: str = public_tokenizers.PATTERN,
         special_tokens: dict[str, int] | None = None) -> tiktoken.Encoding:
    """The encoding of a rank file, or of a byte-level vocabulary whose ids are its ranks."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        byte_of, special = _byte_of(), {x["content"] for x in model.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): rank
                 for token, rank in model["model"]["vocab"].items() if token not in special}
    else:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks,
                             special_tokens=special_tokens or {})


def added_tokens(path: str) -> dict[str, int]:
    """The ids of the added tokens of a byte-level vocabulary; a rank file has none."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if any(x[flag] for x in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that look at their surroundings are not supported")
    return {x["content"]: x["id"] for x in added}


def long_pieces(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """A text in pieces of about `size` characters, cut at safe boundaries only.

    A stretch without a safe boundary stays whole, however long it is.
    """
    at = 0
    while len(text) - at > size:
        cut = SAFE_BOUNDARY.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(encoding: tiktoken.Encoding, text: str, added: dict[str, int] | None = None,
                ) -> np.ndarray:
    """Token ids of a text. Texts in `added` become their ids, what is between them is encoded
    for itself; without it special tokens are ordinary text."""
    if added and any(x in text for x in added):
        longest_first = sorted(added, key=len, reverse=True)
        parts = re.split("(" + "|".join(map(re.escape, longest_first)) + ")", text)
        return np.concatenate([np.array([added[x]], np.uint32) if k % 2 else
                               encode_text(encoding, x) for k, x in enumerate(parts)])
    parts = [encoding.encode_to_numpy(piece, disallowed_special=()) for piece in long_pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


class PlainFirst:
    """Encodes texts with a pattern that looks nowhere ahead, which takes less time; the same ids.

    Both patterns differ only in runs of white space before something else, the last of which the
    look-ahead leaves to what follows. Cut there, a text has no such runs; one with many of them is
    encoded with the look-ahead.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.path, self.pattern = path, pattern
        self.plain = (load(path, pattern.removesuffix(RUNS) + PLAIN_RUNS, NEVER)
                      if pattern.endswith(RUNS) else self.encoding)

    @cached_property
    def encoding(self) -> tiktoken.Encoding:
        """The one with the look-ahead, loaded if a text needs it."""
        return load(self.path, self.pattern, NEVER)

    def encode_text(self, text: str) -> np.ndarray:
        cuts = [x.end() for x in RUN_END.finditer(text)]
        if not cuts:
            return encode_text(self.plain, text)
        if len(cuts) * FEW_RUNS > len(text):
            return encode_text(self.encoding, text)
        return np.concatenate([encode_text(self.plain, text[a:b])
                               for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)])


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Token ids of every whole text: doc_id, n_tokens, ids (little-endian unsigned 32-bit).

    One row per input row, in no order; repeated rows give repeated rows. A null or empty text has
    no tokens. Ids may be null. Columns other than doc_id and text are ignored. The rank file has
    to be at `path` on every executor. Nothing is shuffled.
    """
    def run(batches):
        encoding = load(path, pattern)
        for batch in slices(batches):
            ids = [encode_text(encoding, text) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, TOKENS)


def decode(tokens: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The bytes that ids stand for: doc_id, n_tokens, ids, decoded (binary).

    Bytes, not text: a cut between tokens may fall inside a character. Null ids give null bytes,
    no ids give no bytes.
    """
    def run(batches):
        encoding = load(path, pattern)
        for batch in slices(batches, "ids"):
            decoded = [None if x is None
                       else encoding.decode_bytes(np.frombuffer(x, dtype="<u4").tolist())
                       for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())],
                names=[*batch.schema.names, "decoded"])

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, TOKENS + ", decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """SHA-256 of the decimal ids joined by commas and of the decoded bytes, in lowercase hex."""
    def run(batches):
        width = 11
        for batch in slices(batches, "ids"):
            listed = []
            for x in batch.column("ids").to_pylist():
                ids = np.frombuffer(x or b"", dtype="<u4")
                texts = np.zeros((len(ids), width), dtype=np.uint8)
                texts[:, :width - 1] = ids.astype(f"S{width - 1}").view(np.uint8).reshape(
                    -1, width - 1)
                texts[:, width - 1] = ord(",")
                listed.append(texts[texts != 0].tobytes()[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"),
                 pa.array([hashlib.sha256(x).hexdigest() for x in listed]),
                 pa.array([hashlib.sha256(x or b"").hexdigest()
                           for x in batch.column("decoded").to_pylist()])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return decoded.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
