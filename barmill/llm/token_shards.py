"""Token ids as raw binary shards in ascending order of the document key, with a minimal perfect hash index.

A shard is two files in the shared folder: `.ids` holds the ids of its documents end to end (16 bits each if the
vocabulary allows, else 32), `.idx` maps a document key to its place. The index is a minimal perfect hash of bit arrays
in levels: a key takes the first level in which no other key has its bit, and the number of bits before it is its
slot. A slot holds a fingerprint, so that a key the shard lacks is told apart, and the document's first row; rows hold
offsets into the ids. Keys themselves are not stored. A lookup reads the header, a page of each array that it touches
and one range of the payload, however large the shard is; many lookups in a shard share their pages.

Documents reach their shards by a range exchange. Each task writes its shard under its attempt's name, and the manifest
names the files of the attempts that Spark has committed, so a task that runs again or twice harms nothing.
"""

from __future__ import annotations

import json
import struct
from collections import OrderedDict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm import library
from barmill.llm.common import binary_array, byte_slices, ragged, shared_dir, text_rows, written

MAGIC = b"BARMILL2"
#: Bytes of a page of the index, how many pages a reader keeps, and bytes of payload that one read takes.
PAGE, PAGES, PAYLOAD = 1 << 16, 1 << 10, 4 << 20
#: Bytes of text that a task encodes at a time (one text at least); the arrays at work then are some 25 times as large.
SLICE = 2 << 20
_GAMMA = 2
_LEVELS = 64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one mix of 64-bit keys for each seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash(NamedTuple):
    """sizes: bits of each level; bits: the levels' bit arrays end to end; before: set bits ahead of each word. Both as functions from places to values."""

    sizes: list[int]
    bits: Callable[[np.ndarray], np.ndarray]
    before: Callable[[np.ndarray], np.ndarray]

    @staticmethod
    def arrays(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        """sizes, bits and before of distinct 64-bit integers."""
        rest, words, sizes = keys.view(np.uint64), [], []
        while len(rest):
            if len(sizes) == _LEVELS:
                raise ValueError("keys repeat")
            size = (_GAMMA * len(rest) + 63) // 64 * 64
            at = (_mix(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
            count = np.bincount(at, minlength=size)
            words.append(np.packbits(count == 1, bitorder="little").view("<u8"))
            sizes.append(size)
            rest = rest[count[at] > 1]
        bits = np.concatenate(words) if words else np.zeros(0, "<u8")
        ones = np.bitwise_count(bits).astype(np.int64)
        return sizes, bits, np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, before = cls.arrays(keys)
        return cls(sizes, bits.__getitem__, before.__getitem__)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if no level has its bit; a key that wasn't built in may get any slot."""
        keys = keys.view(np.uint64)
        out, rest, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(rest):
                break
            at = (_mix(keys[rest], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.bits(at >> 6), (at & 63).astype(np.uint64)
            has = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[has] & ((np.uint64(1) << bit[has]) - np.uint64(1)))
            out[rest[has]] = self.before(at[has] >> 6) + below
            rest, base = rest[~has], base + size
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys.view(np.uint64), 1 << 20) >> np.uint64(32)).astype("<u4")


def index_bytes(keys: np.ndarray, nulls: int, offsets: np.ndarray) -> bytes:
    """The index of rows with these offsets; keys: of the rows after `nulls` rows without a key, in ascending order; equal ones are one entry of several rows."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    own = keys[first]
    sizes, bits, before = PerfectHash.arrays(own)
    slot = PerfectHash(sizes, bits.__getitem__, before.__getitem__).slots(own)
    parts = {"bits": bits, "before": before, "offsets": offsets.astype("<i8")}
    for name, values in (("row", first + nulls), ("rows", np.diff(np.append(first, len(keys)))), ("fingerprint", fingerprints(own))):
        parts[name] = np.empty_like(values)
        parts[name][slot] = values
    at, places = 0, {}
    for name, values in parts.items():
        places[name] = [at, values.dtype.str, len(values)]
        at += -(-values.nbytes // 8) * 8
    head = json.dumps({"sizes": sizes, "nulls": nulls, "parts": places}).encode()
    head += b" " * (-(len(head) + 12) % 8)
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(v.tobytes() + b"\0" * (-v.nbytes % 8) for v in parts.values())


class Index:
    """Keyed access to a shard's rows; reads pages of the index as they are asked for. bytes_read: how much that was."""

    def __init__(self, file):
        self._file, self._pages, self.bytes_read = file, OrderedDict(), 0
        start = self._read(0, 4096)
        if start[:8] != MAGIC:
            raise ValueError("no index file")
        n = struct.unpack_from("<I", start, 8)[0]
        if n > 4084:
            start += self._read(4096, n - 4084)
        head = json.loads(start[12 : 12 + n])
        self._parts, self._base, self.nulls = head["parts"], 12 + n, head["nulls"]
        self.hash = PerfectHash(head["sizes"], lambda at: self.take("bits", at), lambda at: self.take("before", at))

    def _read(self, at: int, n: int) -> bytes:
        out = self._file.read_at(n, at)
        self.bytes_read += len(out)
        return out

    def take(self, name: str, at: np.ndarray) -> np.ndarray:
        """Values of an array of the index at these places."""
        begin, kind, _ = self._parts[name]
        width = int(kind[2:])
        where = self._base + begin + np.asarray(at, np.int64) * width
        pages, place = np.unique(where // PAGE, return_inverse=True)
        missing = [p for p in pages.tolist() if p not in self._pages]
        for a, b in _runs(missing):
            raw = self._read(a * PAGE, (b - a) * PAGE)
            for p in range(a, b):
                self._pages[p] = raw[(p - a) * PAGE : (p - a + 1) * PAGE]
        own = b"".join(self._pages[p] for p in pages.tolist())
        for p in pages.tolist():
            self._pages.move_to_end(p)
        while len(self._pages) > PAGES:
            self._pages.popitem(last=False)
        odd = self._base % width  # arrays are laid out from there
        return np.frombuffer(own, kind, (len(own) - odd) // width, odd)[(place * PAGE + where % PAGE - odd) // width] if len(own) else np.zeros(0, kind)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row of each key and how many rows it has; (-1, 0) for a key whose fingerprint isn't there."""
        slot = self.hash.slots(keys)
        at = np.flatnonzero(slot >= 0)
        at = at[self.take("fingerprint", slot[at]) == fingerprints(keys[at])]
        row, rows = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        row[at], rows[at] = self.take("row", slot[at]), self.take("rows", slot[at])
        return row, rows


def _runs(numbers: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as runs of neighbours, end exclusive."""
    out: list[list[int]] = []
    for p in numbers:
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [(a, b) for a, b in out]


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encoder = library.load(tokenizer)
        kind = "<u2" if max(encoder.size - 1, end_id) < 1 << 16 else "<u4"
        store, root = _store(folder)
        store.create_dir(root)
        name = f"shard-{context.partitionId():08d}-{context.taskAttemptId()}"
        keys, counts, nulls = [], [], 0
        with store.open_output_stream(f"{root}/{name}.ids") as out:
            for batch in batches:
                for part in byte_slices(batch, most=SLICE):
                    ids, count = encoder.encode_column(part.column(1))
                    out.write(np.insert(ids.astype(kind), np.cumsum(count), end_id).tobytes())
                    counts.append(count + 1)
                    nulls += part.column(0).null_count
                    keys.append(part.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        with store.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(index_bytes(keys, nulls, offsets))
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([context.partitionId()], pa.int32()),
                "path": [f"{folder}/{name}"],
                "id_bytes": pa.array([int(kind[2])], pa.int32()),
                "n_docs": [len(offsets) - 1],
                "n_ids": [int(offsets[-1])],
                "nulls": [nulls],
                "least": pa.array([int(keys[0]) if len(keys) else None], pa.int64()),
                "most": pa.array([int(keys[-1]) if len(keys) else None], pa.int64()),
            }
        )

    return run


def write_shards(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, folder: str | None = None, shards: int | None = None) -> DataFrame:
    """Writes the ids of every row, each text followed by end_id, in ascending order of the integer key; gives the manifest.

    Manifest: shard, path, id_bytes, n_docs, n_ids, nulls (rows without a key), least and most key, start (ids in the
    shards before it), one row a shard. Null keys come first; a null text counts as empty and has only the end id. Rows
    that repeat a key follow each other, ordered by a hash of their texts. An empty table gives empty shards or none.
    Further columns are left out.
    """
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "token-shards")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    manifest = written(dealt.mapInArrow(_writer(folder, tokenizer, end_id), "shard int, path string, id_bytes int, n_docs long, n_ids long, nulls long, least long, most long"), "token-manifest")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row a shard
    return manifest.withColumn("start", F.coalesce(before, F.lit(0).cast("long")))


def lookup(manifest: DataFrame, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids) for every given key that is there, a row for each of its rows; ids as little-endian unsigned 32-bit integers.

    Keys go to the shards whose range holds them, then each is a probe of the perfect hash. Keys that repeat count once,
    unknown ones give no row, a null key gives the rows without a key.
    """
    held = manifest.where("n_docs > 0").orderBy("shard").collect()  # one row a shard
    with_key = [k for k, x in enumerate(held) if x.least is not None]
    with_null = np.array([k for k, x in enumerate(held) if x.nulls], np.int32)
    least, most = (np.array([held[k][c] for k in with_key], np.int64) for c in ("least", "most"))
    shard_of = np.array(with_key, np.int32)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.unique(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            a, b = np.searchsorted(most, own), np.searchsorted(least, own, side="right")
            number = np.maximum(b - a, 0)
            yield pa.RecordBatch.from_arrays([pa.array(shard_of[ragged(a, number)]), pa.array(np.repeat(own, number))], names=["place", "doc_id"])
            if batch.column(0).null_count:
                yield pa.RecordBatch.from_arrays([pa.array(with_null), pa.nulls(len(with_null), pa.int64())], names=["place", "doc_id"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, index, payload = None, None, None
        for batch in batches:
            places = batch.column(0).to_numpy()
            for k in np.unique(places).tolist():
                if opened != k:
                    store, path = _store(held[k].path)
                    opened, index, payload = k, Index(store.open_input_file(f"{path}.idx")), store.open_input_file(f"{path}.ids")
                asked = batch.column(1).filter(pa.array(places == k))
                own = asked.drop_null().to_numpy(zero_copy_only=False)
                row, rows = index.find(own)
                if asked.null_count:
                    yield from _rows(index, payload, held[k], np.arange(index.nulls), None)
                yield from _rows(index, payload, held[k], ragged(row, rows), np.repeat(own, rows))

    asked = keys.select(F.col(key_col).cast("long").alias("doc_id")).distinct().mapInArrow(place, "place int, doc_id long")
    dealt = asked.repartitionById(max(1, len(held)), F.col("place")).sortWithinPartitions("place", "doc_id")
    return dealt.mapInArrow(probe, "doc_id long, start long, n_tokens long, ids binary")


def _rows(index: Index, payload, shard, row: np.ndarray, keys: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The given rows of a shard, neighbours in one read of the payload."""
    if not len(row):
        return
    order = np.argsort(row, kind="stable")
    row, keys = row[order], None if keys is None else keys[order]
    begin, end = index.take("offsets", row), index.take("offsets", row + 1)
    width = shard["id_bytes"]
    breaks = (row[1:] != row[:-1] + 1) | (np.diff((end - begin[0]) * width // PAYLOAD) > 0)
    cuts = [0, *(np.flatnonzero(breaks) + 1).tolist(), len(row)]
    for a, b in zip(cuts, cuts[1:]):
        raw = payload.read_at(int(end[b - 1] - begin[a]) * width, int(begin[a]) * width)
        ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(b - a, pa.int64()) if keys is None else pa.array(keys[a:b]),
                pa.array(begin[a:b] + shard["start"]),
                pa.array(end[a:b] - begin[a:b]),
                binary_array(ids, (np.append(begin[a:b], end[b - 1]) - begin[a]) * 4),
            ],
            names=["doc_id", "start", "n_tokens", "ids"],
        )
