"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes of text that are hashed in one go.
BLOCK = 1 << 20

_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_OF_BYTE = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_OF_BYTE[65:91] = _OF_BYTE[97:123]  # A-Z count as a-z


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_BASE)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


def word_hashes(raw: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a text given as bytes, A-Z as a-z.

    The hash of a word is a difference of running sums of byte values times powers, moved to the
    start of the word. Blocks end at white space, so no word is cut.
    """
    hashes, starts, at = [], [], 0
    while at < len(raw):
        to = min(at + BLOCK, len(raw))
        while to < len(raw) and not _WHITE[raw[to]]:
            more = np.flatnonzero(_WHITE[raw[to:to + BLOCK]])
            to = to + int(more[0]) if len(more) else min(to + BLOCK, len(raw))
        part = raw[at:to]
        white = _WHITE[part]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], white, [True])).astype(np.int8)))
        first, after = edge[::2], edge[1::2]
        up, down = powers.of(len(part) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[part] * up[:-1])))
        hashes.append(mixed((sums[after] - sums[first]) * down[first]
                            + (after - first).astype(np.uint64)))
        starts.append(first + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def hashed_words(batch: pa.RecordBatch, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch's texts, in order, and where each text's words end.

    Words are runs without the ASCII white space \\x20 and \\x09-\\x0D; A-Z count as a-z.
    """
    texts = batch.column("text").cast(pa.large_binary()).fill_null(b"").to_pylist()
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    hashes, starts = word_hashes(raw, powers)
    ends = np.cumsum([len(x) + 1 for x in texts])
    return hashes, np.searchsorted(starts, ends)
