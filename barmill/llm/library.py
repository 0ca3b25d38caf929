"""A byte-level BPE file as the tokenizers library encodes it, on the distinct chunks of a column.

Chunks that begin with a blank and end with another character are laid end to end for the library: its split never
spans such a border, so the ids of each chunk are found again by the bytes of the tokens. Other chunks are encoded one
by one. Ids of the chunks seen are kept for the next batches of the worker, up to a bound.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import pyarrow as pa

from barmill.llm.chunks import Chunks, sums
from barmill.llm.common import ragged

#: Chunks whose ids a worker keeps, and their longest; what is kept is at most some 100 MB.
KEPT, KEPT_BYTES = 1 << 19, 24
#: Bytes of text in one call to the tokenizer.
BATCH_BYTES = 1 << 18


def spec_of(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def has_safe_borders(spec: dict) -> bool:
    """Whether texts of a tokenizers file may be cut before a blank that follows another character."""
    split = spec["pre_tokenizer"] or {}
    plain = spec["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    return plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class Encoder:
    """Ids of texts by the library; only for files with safe borders."""

    def __init__(self, path: str):
        spec = spec_of(path)
        if not has_safe_borders(spec):
            raise ValueError(f"{path}: no plain byte-level BPE file, its texts can't be cut")
        self._library = tokenizer(path)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*spec["model"]["vocab"].values(), *special.values()]) + 1
        self._bytes = np.zeros(self.size, np.int64)  # a character of a byte-level token is a byte
        for token, i in spec["model"]["vocab"].items():
            self._bytes[i] = len(token)
        for token, i in special.items():
            self._bytes[i] = len(token.encode())
        self._slot: dict[bytes, int] = {}
        self._pool, self._first, self._count = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column in order, and how many each has."""
        own = Chunks(column)
        pool, first, count = self._chunks(*own.distinct())
        return pool[ragged(first[own.row], count[own.row])], sums(count[own.row], own.number)

    def count_column(self, column: pa.Array) -> np.ndarray:
        """How many ids each text of a column has."""
        own = Chunks(column)
        return sums(self._chunks(*own.distinct())[2][own.row], own.number)

    def _chunks(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool of ids, first and number of each chunk's in it)."""
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(starts.tolist(), (starts + lengths).tolist())]
        slot = np.fromiter((self._slot.get(x, -1) for x in names), np.int64, len(names))
        new = np.flatnonzero(slot < 0)
        ids, begin, count = self._library_ids([names[k] for k in new.tolist()])
        pool, firsts, counts = np.concatenate([self._pool, ids]), np.concatenate([self._first, begin + len(self._pool)]), np.concatenate([self._count, count])
        slot[new] = len(self._first) + np.arange(len(new))
        short = lengths[new] <= KEPT_BYTES
        room = KEPT - len(self._slot)
        if room > 0 and short.any():
            kept = np.flatnonzero(short)[:room]
            self._slot.update(zip((names[k] for k in new[kept].tolist()), range(len(self._first), len(self._first) + len(kept))))
            self._pool = np.concatenate([self._pool, ids[ragged(begin[kept], count[kept])]])
            self._count = np.concatenate([self._count, count[kept]])
            self._first = np.cumsum(self._count) - self._count
        return pool, firsts[slot], counts[slot]

    def _library_ids(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool of ids, first and number of each chunk's in it)."""
        texts = [x.decode() for x in chunks]
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        joinable = np.fromiter((x[0] == " " and not x[-1].isspace() for x in texts), bool, len(texts))
        pool, size, first, count = [np.zeros(0, np.int32)], 0, np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        at, alone = np.flatnonzero(joinable), np.flatnonzero(~joinable).tolist()
        for a, b in _cuts(np.cumsum(lengths[at]) // BATCH_BYTES):
            own = at[a:b]
            got = np.array(self._library.encode_batch_fast(["".join([texts[k] for k in own.tolist()])], add_special_tokens=False)[0].ids, np.int32)
            covered, wanted = np.cumsum(self._bytes[got]), np.cumsum(lengths[own])
            ends = np.searchsorted(covered, wanted)
            if not (covered[ends] == wanted).all():  # a border that a token spans, which the library's split excludes
                alone += own.tolist()
                continue
            ends = ends + 1
            first[own[1:]], first[own[0]] = size + ends[:-1], size
            count[own] = np.diff(ends, prepend=0)
            pool.append(got)
            size += len(got)
        for a, b in _cuts(np.cumsum(lengths[alone]) // BATCH_BYTES if alone else np.zeros(0, np.int64)):
            got = [x.ids for x in self._library.encode_batch_fast([texts[k] for k in alone[a:b]], add_special_tokens=False)]
            count[alone[a:b]] = [len(x) for x in got]
            first[alone[a:b]] = size + np.cumsum(count[alone[a:b]]) - count[alone[a:b]]
            pool.append(np.array([i for x in got for i in x], np.int32))
            size += len(pool[-1])
        return np.concatenate(pool), first, count


def _cuts(part: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal numbers begin and end."""
    if not len(part):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    return list(zip(cuts, cuts[1:]))


class Whole:
    """Ids of whole texts by the library, for files whose texts can't be cut."""

    def __init__(self, path: str):
        self._library = tokenizer(path)
        self.size = self._library.get_vocab_size()

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids = [np.array(x.ids, np.int32) for x in self._library.encode_batch_fast(column.to_pylist(), add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))


@functools.lru_cache(maxsize=2)
def load(path: str) -> Encoder | Whole:
    """Read once for each Python worker."""
    return Encoder(path) if has_safe_borders(spec_of(path)) else Whole(path)
