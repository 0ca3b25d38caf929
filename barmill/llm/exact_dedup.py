"""Exact dedup by an extendible-hash index on shared files.

Each normalised text has a 64-bit key. The directory starts with one bucket and doubles while a bucket holds more keys
than its capacity: the overfull bucket is split by the next bit. Contiguous buckets form the key range of an owner
task, which gets the texts of its range sorted by key, chains texts that share a key, and compares their bytes. The
owners' entries are the index: Parquet files in the shared folder, each of one key range, beside the directory.

Copies are combined within each scan task first, so a text that fills a third of all rows reaches its owner once for
every TASK_BYTES of distinct texts that a task reads, and rows find their group by a join that can be split where a key is hot.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm.common import binary_array, byte_slices, kept_rows, string_bytes, string_offsets, text_rows, written

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: The directory never goes deeper than this; a bucket that is overfull there just has more entries.
DEEPEST = 20
#: Distinct texts that a scan task gathers before it sends them on, in bytes.
TASK_BYTES = 64 << 20
_NO_ID = np.iinfo(np.int64).min


class Directory(NamedTuple):
    """bucket and owner of each key prefix of `depth` bits; local[b]: bits that bucket b looks at."""

    depth: int
    bucket: np.ndarray
    owner: np.ndarray
    local: np.ndarray


def directory(counts: np.ndarray, capacity: int, owners: int) -> Directory:
    """Splits overfull buckets, doubling the directory as needed. counts: keys by prefix, a power of two of them."""
    depth = int(len(counts)).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(counts)])
    buckets, todo = [], [(0, 0)]
    while todo:
        prefix, local = todo.pop()
        a, b = prefix << (depth - local), (prefix + 1) << (depth - local)
        if total[b] - total[a] > capacity and local < depth:
            todo += [(2 * prefix + 1, local + 1), (2 * prefix, local + 1)]
        else:
            buckets.append((a, b, local))
    local = np.array([x[2] for x in buckets])
    deepest = int(local.max())
    size = np.array([b - a for a, b, _ in buckets])
    bucket = np.repeat(np.arange(len(buckets)), size)
    keys = np.array([total[b] - total[a] for a, b, _ in buckets])
    owner = ((np.cumsum(keys) - keys) * owners // max(1, int(keys.sum()))).clip(0, owners - 1)
    step = 1 << (depth - deepest)
    return Directory(deepest, bucket[::step].astype(np.int32), owner[bucket][::step].astype(np.int32), local)


def _digests(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Lower-cased bytes of a column, their offsets, and the SHA-256 of each text as four big-endian integers."""
    offsets = string_offsets(column)
    data = bytes(string_bytes(column)[int(offsets[0]) : int(offsets[-1])]).translate(_LOWER)
    offsets = offsets - offsets[0]
    view, ends = memoryview(data), offsets.tolist()
    sha = b"".join(hashlib.sha256(view[a:b]).digest() for a, b in zip(ends, ends[1:]))
    return data, offsets, np.frombuffer(sha, ">u8").reshape(-1, 4)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch):
            _, _, sha = _digests(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(sha[:, 0].astype(np.int64)), binary_array(np.ascontiguousarray(sha), np.arange(len(sha) + 1) * 32)], names=["doc_id", "text_key", "key", "sha"]
            )


def _combined(table: Directory, most: int = TASK_BYTES):
    """Distinct texts of a task, with the owner and bucket of their keys, sent on when they hold `most` bytes."""

    def sent(pending: dict) -> pa.RecordBatch:
        sha = np.frombuffer(b"".join(own for own, _ in pending), ">u8").reshape(-1, 4)
        texts, ids, sizes = zip(*pending.values())
        key = sha[:, 0].astype(np.uint64)
        prefix = (key >> np.uint64(64 - table.depth)).astype(np.int64) if table.depth else np.zeros(len(key), np.int64)
        keep = np.asarray(ids, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(table.owner[prefix]),
                pa.array(table.bucket[prefix]),
                pa.array(key.view(np.int64)),
                binary_array(np.ascontiguousarray(sha), np.arange(len(sha) + 1) * 32),
                pa.array(texts, pa.binary()),
                pa.array(keep, mask=keep == _NO_ID),
                pa.array(sizes, pa.int64()),
            ],
            names=["owner", "bucket", "key", "sha", "bytes", "keep_id", "group_size"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[tuple, list] = {}  # by digest and place among the texts of that digest: text, largest id, rows
        held = 0
        for batch in batches:
            for part in byte_slices(batch):
                data, offsets, sha = _digests(part.column(1))
                cuts, ids = offsets.tolist(), part.column(0).fill_null(_NO_ID).to_pylist()
                for k, own in enumerate(map(bytes, sha)):
                    text, n = data[cuts[k] : cuts[k + 1]], 0
                    while (entry := pending.get((own, n))) is not None and entry[0] != text:
                        n += 1
                    if entry is None:
                        pending[own, n] = [text, ids[k], 1]
                        held += len(text) + 256
                    else:
                        entry[1] = max(entry[1], ids[k])
                        entry[2] += 1
                    if held >= most:
                        yield sent(pending)
                        pending, held = {}, 0
        if pending:
            yield sent(pending)

    return run


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An owner's entries: rows come sorted by key; texts of one key form a chain and equal ones become one entry."""
    chain: list[list] = []

    def out(entries: list[list]) -> pa.RecordBatch:
        cols = list(zip(*entries)) if entries else [()] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip((cols[0], cols[1], cols[6], cols[2], cols[4], cols[5]), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()))],
            names=["bucket", "key", "chain", "sha", "keep_id", "group_size"],
        )

    for batch in batches:
        done = []
        bucket, key, sha, data, keep, size = (batch.column(k) for k in range(1, 7))
        keys, sizes, ids = key.to_pylist(), size.to_pylist(), keep.to_pylist()
        buckets, shas = bucket.to_pylist(), sha.to_pylist()
        for k, own in enumerate(keys):
            if chain and chain[0][1] != own:
                done += chain
                chain = []
            text = data[k].as_py() if chain or (k + 1 < len(keys) and keys[k + 1] == own) or k + 1 == len(keys) else None
            for entry in chain:
                if entry[3] == text:
                    entry[4] = ids[k] if entry[4] is None else entry[4] if ids[k] is None else max(entry[4], ids[k])
                    entry[5] += sizes[k]
                    break
            else:
                chain.append([buckets[k], own, shas[k], text, ids[k], sizes[k], len(chain)])
        yield out(done)
    yield out(chain)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, owners: int | None = None) -> tuple[DataFrame, DataFrame, Directory]:
    """(rows, entries, directory): the key of every row, and one entry of the index for each distinct text.

    entries: bucket, key, chain (place among the texts of that key), sha, keep_id, group_size; a Parquet table in the
    shared folder whose files hold one owner's key range each. rows: row_no, doc_id, text_key, key, sha. A null text
    counts as empty; an entry's keep_id is null if no row of its text has an id. An empty table gives empty ones.
    """
    spark = docs.sparkSession
    texts = text_rows(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = written(texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(_hashed, "doc_id long, text_key long, key long, sha binary").withColumn("row_no", F.monotonically_increasing_id()), "dedup-rows")
    total = rows.count()
    depth = min(DEEPEST, max(0, math.ceil(math.log2(max(1, total / capacity)))) + 3)
    prefix = F.shiftrightunsigned("key", 64 - depth).cast("int")
    counts = np.zeros(1 << depth, np.int64)
    for p, n in rows.groupBy(prefix.alias("prefix")).agg(F.approx_count_distinct("key")).toLocalIterator():  # at most 2**DEEPEST rows
        counts[p] = n
    owners = owners or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = directory(counts, capacity, owners)
    found = (
        texts.mapInArrow(_combined(table), "owner int, bucket int, key long, sha binary, bytes binary, keep_id long, group_size long")
        .repartitionById(owners, F.col("owner"))
        .sortWithinPartitions("key")
        .mapInArrow(_chained, "bucket int, key long, chain int, sha binary, keep_id long, group_size long")
    )
    return rows, written(found, "dedup-index"), table


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, bucket, text_key) for every row; texts are equal if they are once A-Z are lower-cased.

    A null text counts as empty. The row with the largest id stays; a null id is smaller than any other. Of rows that
    repeat that id and text, one stays. An empty table gives an empty result; further columns are left out.
    """
    rows, entries, _ = build_index(docs, id_col, text_col, capacity)
    last = rows.groupBy("key", "sha").agg(F.max(F.struct("doc_id", "row_no")).alias("last")).select("key", "sha", F.col("last.row_no").alias("keep_row"))
    groups = written(entries.join(last, ["key", "sha"]), "dedup-groups")  # so that a hot text can be split in the join
    return rows.join(groups, ["key", "sha"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "bucket", "text_key"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the copies that exact_groups() drops, all columns kept; of rows that repeat id and text one stays."""
    return kept_rows(docs, exact_groups(docs, id_col, text_col).where("kept"), id_col, text_col)
