"""Distinct chunks of a batch of texts, found with numpy on the column's bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from barmill.llm.common import ragged, string_bytes, string_offsets

#: Chunks of up to this many bytes are matched with each other; a longer one is kept as its own.
WIDE = 24
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def sums(values: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values, run k having number[k] of them."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(number)
    return total[ends] - total[ends - number]


def _safe(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each position is no white space; positions are 1 at least."""
    last = data[at - 1]
    ok = ~_SPACE[last]
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):
        p = at[wide]
        a, b, c = data[np.maximum(p - 3, 0)], data[np.maximum(p - 2, 0)], last[wide]
        ok[wide] = ~(
            ((b == 0xC2) & ((c == 0x85) | (c == 0xA0)))
            | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
            | ((a == 0xE2) & (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)))
            | ((a == 0xE2) & (b == 0x81) & (c == 0x9F))
            | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
        )
    return ok


class Chunks:
    """The texts of a column cut before each blank that follows a character other than white space.

    row: distinct chunk of every chunk in order; number: chunks of each text (an empty text has none).
    """

    def __init__(self, column: pa.Array):
        offsets = string_offsets(column)
        base, self.size = int(offsets[0]), int(offsets[-1] - offsets[0])
        self.data = np.zeros(self.size + WIDE, np.uint8)
        self.data[: self.size] = np.frombuffer(string_bytes(column), np.uint8)[base : base + self.size]
        offsets = offsets - base
        blank = np.flatnonzero(self.data[1 : self.size] == 32) + 1
        cut = np.zeros(self.size + 1, bool)
        cut[blank[_safe(self.data, blank)]] = True
        cut[offsets[:-1]] = True
        cut[self.size] = False
        starts = np.flatnonzero(cut)
        self.number = np.diff(np.searchsorted(starts, offsets))
        ends = np.append(starts[1:], self.size)
        self.row, kept = _grouped(self.data, starts, ends - starts)
        self.starts, self.lengths = starts[kept], (ends - starts)[kept]

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct chunks laid end to end: bytes, starts and lengths."""
        return self.data[ragged(self.starts, self.lengths)], np.cumsum(self.lengths) - self.lengths, self.lengths


def keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The first WIDE bytes of each chunk as integers; data has WIDE spare bytes at its end."""
    window = np.lib.stride_tricks.as_strided(data, (len(data) - WIDE + 1, WIDE), (1, 1))
    words = window[starts].view("<u8")
    return [words[:, k] & _MASK[np.clip(lengths - 8 * k, 0, 8)] for k in range(WIDE // 8)]


def _grouped(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group of each chunk, and one chunk of each group; equal bytes decide, hashes only find candidates."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = keys(data, starts, lengths)
    mixed = lengths.astype(np.uint64) * _MIX[3]
    for word, by in zip(words, _MIX):
        mixed = (mixed ^ word) * by
        mixed ^= mixed >> np.uint64(29)
    long = np.flatnonzero(lengths > WIDE)
    _, kept, row = np.unique(mixed, return_index=True, return_inverse=True)
    same = lengths == lengths[kept][row]
    for word in words:
        same &= word == word[kept][row]
    same[long] = False
    alone = np.flatnonzero(~same & (kept[row] != np.arange(len(row))))  # long ones, and any whose hash met another's
    row[alone] = len(kept) + np.arange(len(alone))
    return row, np.concatenate([kept, alone])
