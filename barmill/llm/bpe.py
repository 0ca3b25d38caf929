"""Byte-level BPE encoding and decoding over a pair occurrence index.

A partition's distinct text chunks are laid out as one symbol array with links to the neighbours. An index maps each
pair of adjacent symbols to all its positions; the ranks that occur are taken in ascending order from a heap, each is
applied at all its positions at once, and only the lists of the pairs that this creates are updated. As a merge only
creates pairs of higher ranks, this equals merging text by text.

Texts are cut at safe boundaries (before a blank that follows a character other than white space): the token split
of the public pattern never spans such a place, so each distinct chunk of a batch is encoded once.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from barmill.llm.chunks import Chunks, sums
from barmill.llm.common import binary_array, byte_slices, ragged, text_rows
from barmill.llm.library import has_safe_borders, spec_of

#: Fixed value: the split of byte-level BPE texts into pieces before the merges.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Kinds of bytes: letter, digit, other; a chunk with a COMPLEX byte is split by the pattern itself.
LETTER, DIGIT, OTHER, COMPLEX = 1, 2, 3, 0


class ByteBpe:
    """Vocabulary, ranks and special strings of a tokenizers file of kind byte-level BPE."""

    def __init__(self, path: str, most_merges: int | None = None):
        spec = spec_of(path)
        if not has_safe_borders(spec):
            raise ValueError(f"{path}: no plain byte-level BPE file")
        vocab = spec["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(printable))}
        raw = {c: b for b, c in shown.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * self.size
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = bytes(raw[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.first = np.array([vocab[shown[b]] for b in range(256)], dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]][:most_merges]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = self.left * self.size + self.right
        self._order = np.argsort(keys, kind="stable")
        self._keys = keys[self._order]
        self._byte_rank = self.rank(np.repeat(self.first, 256), np.tile(self.first, 256)).astype(np.int32)
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._pieces = regex.compile(PIECES)
        kind = np.full(256, COMPLEX, np.int8)
        kind[:128] = OTHER
        for b in range(128):
            kind[b] = LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else OTHER
        kind[[9, 10, 11, 12, 13, 32, ord("'"), *(t.encode()[0] for t in self.special)]] = COMPLEX
        self._kind = kind

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._order[at], -1)

    def merge(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the byte pieces that begin at starts in data, and the number of ids of each piece."""
        n = len(data)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        symbol = self.first[data]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[starts[1:] - 1] = n
        after[-1] = n
        before[starts] = -1
        at = np.flatnonzero(after < n).astype(np.int32)
        ranks = self._byte_rank[data[at].astype(np.int32) * 256 + data[at + 1]]
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray, ranks: np.ndarray) -> None:
            """Adds positions to the lists of their pairs."""
            keep = ranks >= 0
            at, ranks = at[keep], ranks[keep]
            if not len(at):
                return
            if len(at) > 256 and len(self.left) < 1 << 16:
                ranks = ranks.astype(np.uint16)  # sorted by digits then, not by comparison
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, part in zip(ranks[[0, *cuts]].tolist(), np.split(at, cuts) if len(cuts) else [at]):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(active, r)

        note(at, ranks)
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right = self.left[r], self.right[r]
            at = at[symbol[at] == left]
            nxt = after[at]
            ok = nxt < n
            ok[ok] = symbol[nxt[ok]] == right
            at, nxt = at[ok], nxt[ok]
            if not len(at):
                continue
            if left == right:  # in a run of equal symbols every other position is taken, from its left end
                fresh = np.ones(len(at), bool)
                fresh[1:] = at[1:] != nxt[:-1]
                k = np.arange(len(at))
                odd = (k - np.maximum.accumulate(np.where(fresh, k, 0))) % 2 == 1
                at, nxt = at[~odd], nxt[~odd]
            symbol[at] = self.made[r]
            symbol[nxt] = -1
            end = after[nxt]
            after[at] = end
            has = end < n
            before[end[has]] = at[has]
            prev = before[at]
            p = prev[prev >= 0]
            left_at, right_at = np.concatenate([p, at[has]]), np.concatenate([at[prev >= 0], end[has]])
            if len(left_at):
                note(left_at, self.rank(symbol[left_at], symbol[right_at]))
        alive = symbol >= 0
        count = np.add.reduceat(alive, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
        return symbol[alive].astype(np.int32), count

    def pieces(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Where the pieces of chunks laid end to end begin, and (position, id) of special strings."""
        n = len(data)
        kind = self._kind[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF: letters but for two signs
        kind[lead] = kind[lead + 1] = np.where((data[lead + 1] == 0x97) | (data[lead + 1] == 0xB7), OTHER, LETTER)
        blank = starts[(data[starts] == 32) & (lengths > 1)]
        kind[blank] = kind[blank + 1]  # a leading blank belongs to the first piece
        alone = starts[(data[starts] == 32) & (lengths == 1)]
        kind[alone] = OTHER
        begins = np.zeros(n, bool)
        begins[1:] = kind[1:] != kind[:-1]
        begins[starts] = True
        special = []
        for k in np.flatnonzero(np.minimum.reduceat(kind, starts) == COMPLEX).tolist():
            at = int(starts[k])
            begins[at : at + int(lengths[k])] = False
            for part in self._split(data[at : at + int(lengths[k])].tobytes().decode("utf-8", "replace")):
                begins[at] = True
                if isinstance(part, int):
                    special.append((at, part))
                    at += len(self.bytes_of[part])
                else:
                    at += len(part.encode())
        return np.flatnonzero(begins), special

    def _split(self, text: str) -> list:
        """Pieces of a chunk; a special string is given as its id."""
        if self._cut is None:
            return self._pieces.findall(text)
        out = []
        for part in self._cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            else:
                out += self._pieces.findall(part)
        return out

    def encode_chunks(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks laid end to end (none of them empty), and how many each has."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(starts), np.int64)
        begins, special = self.pieces(data, starts, lengths)
        ids, count = self.merge(data, begins)
        if special:
            first = np.cumsum(count) - count
            keep = np.ones(len(ids), bool)
            for at, i in special:
                k = int(np.searchsorted(begins, at))
                ids[first[k]] = i
                keep[first[k] + 1 : first[k] + count[k]] = False
                count[k] = 1
            ids = ids[keep]
        return ids, np.add.reduceat(count, np.searchsorted(begins, starts))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def load(path: str, most_merges: int | None = None) -> ByteBpe:
    """Read once for each Python worker."""
    return ByteBpe(path, most_merges)


def encode_column(bpe: ByteBpe, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a column in order, and how many each has."""
    own = Chunks(column)
    ids, count = bpe.encode_chunks(*own.distinct())
    first = np.cumsum(count) - count
    each = count[own.row]
    return ids[ragged(first[own.row], each)], sums(each, own.number)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row; ids as little-endian unsigned 32-bit integers in a binary column.

    Special strings in a text become their ids and nothing else is added. Null texts count as empty and have no ids.
    Repeated rows and ids are encoded row by row; further columns of docs are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for batch in batches:
            for part in byte_slices(batch):
                ids, count = encode_column(bpe, part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), _payload(ids, count)], names=["doc_id", "ids"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {_kind(rows)}, ids binary")


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the tokens' bytes joined and read as UTF-8, special tokens kept.

    Null or empty ids give the empty text; bytes that are no UTF-8 become U+FFFD.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for batch in batches:
            texts = [bpe.decode(np.frombuffer(x or b"", np.uint32)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select("doc_id", ids_col)
    return rows.mapInArrow(run, f"doc_id {_kind(rows)}, text string")


def round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): encode() and decode() of every row in one pass, so that ids needn't leave the task between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(tokenizer)
        for batch in batches:
            for part in byte_slices(batch):
                ids, count = encode_column(bpe, part.column(1))
                ends = np.cumsum(count).tolist()
                texts = [bpe.decode(ids[a:b]) for a, b in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([part.column(0), _payload(ids, count), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    rows = text_rows(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {_kind(rows)}, ids binary, decoded string")


def _payload(ids: np.ndarray, count: np.ndarray) -> pa.Array:
    return binary_array(np.ascontiguousarray(ids, dtype="<u4"), np.concatenate([[0], np.cumsum(count)]) * 4)


def _kind(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()
