"""Benchmark decontamination: a broadcast hash set of the benchmark's normalised n-grams against every document window.

Word ids come from the benchmark's own vocabulary; a window can only occur where all its words are known, so windows
are hashed there alone. A hash that meets the set is verified word by word, so hashes never decide.

The set is broadcast in blocks that are bounded by their number of words, long items in pieces that overlap by all but one
word of a window. The documents are scanned once for each block, one block at a time: a larger benchmark means more
scans, never a larger broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import byte_slices, ragged, string_bytes, string_offsets, text_rows, unused, written

#: Words of a broadcast block of the benchmark. Its index takes at most some 220 bytes a word, so 110 MB.
BLOCK_WORDS = 500_000
#: Buckets of hashes over which words of the benchmark are counted.
BUCKETS = 1024

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
#: A-Z to lower case; what separates words to a blank.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if _WORD[c] else 32 for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_NORMAL).split()


class Windows:
    """The distinct windows of some items: by length m, their hashes in order, their word ids, and the items of each."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.vocab: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for name, text in items:
            own = words(text)
            ids = np.fromiter((self.vocab.setdefault(w, len(self.vocab) + 1) for w in own), np.int32, len(own))
            m = min(n, len(ids))
            if m:
                found.setdefault(m, []).append((np.lib.stride_tricks.sliding_window_view(ids, m), number[name]))
        self.by_length = {}
        for m, own in found.items():
            ids = np.concatenate([x for x, _ in own])
            owner = np.repeat(np.array([k for _, k in own], np.int32), [len(x) for x, _ in own])
            mixed = _mixed([ids[:, k] for k in range(m)])
            order = np.lexsort((owner, *(ids[:, k] for k in range(m)), mixed))
            mixed, ids, owner = mixed[order], ids[order], owner[order]
            opens = np.append(True, (ids[1:] != ids[:-1]).any(axis=1))
            fresh = opens | np.append(True, owner[1:] != owner[:-1])  # an item that has a window twice counts once
            first = np.cumsum(fresh)[opens] - 1
            self.by_length[m] = (mixed[opens], ids[opens], first, np.diff(np.append(first, fresh.sum())), owner[fresh])


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out ^ c.astype(np.uint64)) * _STEP
        out ^= out >> np.uint64(31)
    return out


def scan(windows: Windows, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hit flag of each word, and the distinct (document, item) pairs; ids: word ids, 0 if unknown, of documents that begin at starts.

    Every document must be followed by a 0.
    """
    unknown = np.concatenate([[0], np.cumsum(ids == 0)])
    change = np.zeros(len(ids) + 1, np.int64)
    pairs = []
    for m, (mixed, rows, first, count, owner) in windows.by_length.items():
        at = np.flatnonzero(unknown[m:] == unknown[:-m])
        if not len(at):
            continue
        own = _mixed([ids[at + k] for k in range(m)])
        place = np.searchsorted(mixed, own)
        last = np.searchsorted(mixed, own, side="right")
        while len(at):  # windows that share a hash stand side by side; there is hardly ever more than one
            ok = place < last
            at, place, last = at[ok], place[ok], last[ok]
            if not len(at):
                break
            same = np.ones(len(at), bool)
            for k in range(m):
                same &= ids[at + k] == rows[place, k]
            hit = at[same]
            change[hit] += 1
            np.subtract.at(change, hit + m, 1)
            own_first, own_count = first[place[same]], count[place[same]]
            pairs.append(np.stack([np.repeat(np.searchsorted(starts, hit, side="right") - 1, own_count), owner[ragged(own_first, own_count)]], axis=1))
            place = place + 1
    return np.cumsum(change[:-1]) > 0, np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _spans(text: str, flags: np.ndarray) -> list[tuple[int, int]]:
    """Code point spans of the text from the first to the last word of each run of hit words."""
    found = [(x.start(), x.end()) for x in re.finditer("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)]
    return [(found[a][0], found[b - 1][1]) for a, b in _runs(flags)]


_FOUND = "n_words long, hit array<struct<start:long,end:long>>, spans array<struct<start:long,end:long>>, items array<string>"


def _scanner(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows: Windows = block.value
        get = windows.vocab.get
        for batch in batches:
            for part in byte_slices(batch):
                column = part.column(2)
                offsets = string_offsets(column)
                data = bytes(string_bytes(column)[int(offsets[0]) : int(offsets[-1])]).translate(_NORMAL)
                cuts = (offsets - offsets[0]).tolist()
                each, number = [], []
                for a, b in zip(cuts, cuts[1:]):
                    own = data[a:b].split()
                    each.append(np.fromiter(map(get, own, repeat(0)), np.int64, len(own)))
                    each.append(np.zeros(1, np.int64))
                    number.append(len(own))
                count = np.array(number, np.int64)
                starts = np.cumsum(count + 1) - count - 1
                flags, pairs = scan(windows, np.concatenate(each), starts)
                hit, spans, items = [[] for _ in number], [[] for _ in number], [[] for _ in number]
                for d, i in pairs.tolist():
                    items[d].append(windows.names[i])
                for d in np.unique(pairs[:, 0]).tolist():
                    own = flags[starts[d] : starts[d] + count[d]]
                    hit[d] = [{"start": a, "end": b} for a, b in _runs(own)]
                    spans[d] = [{"start": a, "end": b} for a, b in _spans(column[d].as_py(), own)]
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(count), pa.array(hit, span), pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                    names=["doc_id", "text_key", "n_words", "hit", "spans", "items"],
                )

    return run


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """(doc_id, text_key, n_words, hit, spans, items) for every row.

    A window is n consecutive words of an item, or all the words of a shorter one. hit: runs of word places (end
    exclusive) inside occurrences of windows; spans: the same in code points of the text; items: ids, as strings in
    order, of the items that occur. Null or empty texts have no words and an item without words never occurs; items
    that repeat an id count as one, a null id as "". An empty benchmark hits nothing; repeated rows each get a row.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0  # a word and what parts it from the next take two bytes at least
    blocks = max(1, math.ceil(size / block_words))
    kind = rows.schema["doc_id"].dataType.simpleString()
    if blocks > 1:
        items = written(dealt_items(items, n, block_words), "benchmark-pieces")
        blocks = (items.agg(F.max("block")).first()[0] or 0) + 1

    def scanned(own: DataFrame) -> tuple[DataFrame, object]:
        block = spark.sparkContext.broadcast(Windows([tuple(r) for r in own.select("item", "text").toLocalIterator()], n))
        return rows.mapInArrow(_scanner(block), f"doc_id {kind}, text_key long, {_FOUND}"), block

    if blocks == 1:
        return scanned(items)[0]
    first, more = None, None
    for k in range(blocks):  # one block at a time is in memory
        found, block = scanned(items.where(F.col("block") == k))
        found = written(found if k == 0 else found.where("size(items) > 0"), "benchmark-hits")
        block.destroy()
        first = found if k == 0 else first
        hits = found.where("size(items) > 0")
        more = hits if more is None else more.unionByName(hits)
    merged = more.groupBy("doc_id", "text_key").agg(
        *(_union(c) for c in ("hit", "spans")), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    merged = merged.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), *(F.col(c).alias(f"__{c}") for c in ("hit", "spans", "items")))
    out = first.join(merged, first["doc_id"].eqNullSafe(merged["__id"]) & (first["text_key"] == merged["__key"]), "left")
    return out.select("doc_id", "text_key", "n_words", *(F.coalesce(f"__{c}", c).alias(c) for c in ("hit", "spans", "items")))


def dealt_items(items: DataFrame, n: int, block_words: int) -> DataFrame:
    """(item, text, words, block): distinct pieces of items, dealt to blocks of at most block_words words by running counts.

    A block takes the pieces that begin within a stretch of block_words less the longest piece, so the last one fits too.
    Counts run within buckets of hashes and over the buckets. A window isn't cut: where
    block_words is less than 2 n, a block has 2 n words at most.
    """
    most = max(n, block_words // 4)
    pieces = items.mapInArrow(_pieces(n, most), "item string, text string").where("text <> ''").distinct()
    own = pieces.withColumns({"words": F.size(F.split("text", " ")).cast("long"), "bucket": F.pmod(F.xxhash64("item", "text"), F.lit(BUCKETS))})
    w = Window.partitionBy("bucket").orderBy("item", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = own.groupBy("bucket").agg(F.sum("words").alias("sum"))
    before = sums.select("bucket", (F.sum("sum").over(Window.orderBy("bucket")) - F.col("sum")).alias("before"))  # at most BUCKETS rows
    start = F.col("before") + F.sum("words").over(w) - F.col("words")
    return own.join(F.broadcast(before), "bucket").select("item", "text", "words", F.floor(start / max(1, block_words - most)).alias("block"))


def _pieces(n: int, most: int):
    """Items cut into pieces of at most `most` words, so that each window lies in one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [w.decode() for w in words(text)]
                step = most - n + 1
                cut = [" ".join(own[k : k + most]) for k in range(0, max(1, len(own) - n + 1), step)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut), pa.string()), pa.array(cut, pa.string())], names=["item", "text"])

    return run


def _union(column: str):
    """Spans of all blocks of a row, sorted, those that overlap or touch made one."""
    spans = F.array_sort(F.flatten(F.collect_list(column)))
    return F.aggregate(
        spans,
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda out, x: F.when(
            (F.size(out) > 0) & (F.element_at(out, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))),
                F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(out, F.array(x))),
    ).alias(column)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs without what find_contamination() finds: remove="documents" drops the documents, "spans" cuts the spans out of the text.

    All columns are kept; a null text stays null. Ids and texts together identify a row; repeated rows are treated alike.
    An empty table gives an empty one, an empty benchmark leaves docs as they are.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove: {remove}")
    found = find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **params).where("size(items) > 0")
    key, own_id, own_text, spans = (unused(docs, c) for c in ("__key", "__id", "__text", "__spans"))
    found = found.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_text), F.col("spans").alias(spans)).dropDuplicates([own_id, own_text])
    own = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    match = own[id_col].eqNullSafe(found[own_id]) & (own[key] == found[own_text])
    if remove == "documents":
        return own.join(found, match, "left_anti").drop(key)
    joined = own.join(found, match, "left")
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at")),
        lambda out, x: F.struct(
            F.concat(out["text"], F.substr(F.col(text_col), (out["at"] + 1).cast("int"), (x["start"] - out["at"]).cast("int"))).alias("text"), x["end"].alias("at")
        ),
        lambda out: F.concat(out["text"], F.substr(F.col(text_col), (out["at"] + 1).cast("int"))),
    )
    return joined.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(cut)).select(*docs.columns)
