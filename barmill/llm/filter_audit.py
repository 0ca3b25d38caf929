"""Audit of how document filters interact: what each removes in every order in which they may be applied.

One of the filters is on copies. They are found by partition refinement: texts are split by their length in code points,
then by the hashes of successive blocks, each longer than the one before; after every split the singletons are dropped.
Only what survives is compared as full texts. Then each document is a mask of the filters that it fails, and everything
else is computed from the counts of masks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import byte_slices, string_bytes, string_offsets, text_rows, written

FILTERS = "ABCDE"
#: Bytes of the first block; each further one is so many times as long.
BLOCK, LONGER = 64, 16
#: Bits of the largest filter on surviving classes that is sent to tasks, and how many it has for each class below that.
MOST_BITS, BITS_EACH = 1 << 26, 16

_UPPER = bytes(range(65, 91))
_MARKS = b"#$%&*|"


def _blocks(data: memoryview) -> list[int]:
    """Hashes of the blocks of a text, as signed integers; their number depends on its length alone."""
    out, start, size = [], 0, BLOCK
    while start < len(data) or not out:
        out.append(xxhash.xxh64_intdigest(data[start : start + size], len(data)) - (1 << 63))
        start, size = start + size, size * LONGER
    return out


def _class(length: int, blocks: list[int]) -> int:
    """The class of a text once all its blocks have been looked at."""
    return xxhash.xxh64_intdigest(np.array([length, *blocks], "<i8").tobytes()) - (1 << 63)


def _code_points(own: bytes) -> int:
    return len(own) if own.isascii() else len(own.decode())


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, part, text): doc_id, part, the mask of filters A to D that fail, length in code points, block hashes, class and SHA-256."""
    for batch in batches:
        for piece in byte_slices(batch, "text"):
            column = piece.column(2)
            data, cuts = string_bytes(column), string_offsets(column).tolist()
            mask, length, blocks, classes, shas = [], [], [], [], []
            for a, b in zip(cuts, cuts[1:]):
                own = bytes(data[a:b])
                words = own.split()
                n, distinct, size = len(words), len(set(words)), _code_points(own)
                fails = (n < 100, 100 * distinct < 80 * n, 100 * (len(own) - len(own.translate(None, _UPPER))) > 10 * size, len(own.translate(None, _MARKS)) < len(own))
                mask.append(sum(1 << k for k, bad in enumerate(fails) if bad))
                length.append(size)
                blocks.append(_blocks(memoryview(own)))
                classes.append(_class(size, blocks[-1]))
                shas.append(hashlib.sha256(own).digest())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(mask, pa.int32()), pa.array(length, pa.int64()), pa.array(blocks, pa.list_(pa.int64())), pa.array(classes, pa.int64()), pa.array(shas, pa.binary())],
                names=["doc_id", "part", "mask", "length", "blocks", "class", "sha"],
            )


def _surviving(rows: DataFrame) -> DataFrame:
    """Classes of two rows or more once every block was looked at: (class)."""
    deepest = rows.agg(F.max(F.size("blocks"))).first()[0] or 0
    live, done = rows.select("class", "blocks", F.xxhash64("length").alias("cell")), None
    for k in range(deepest + 1):
        if k:  # those that have a k-th block are split by it, the others are through
            through = live.where(F.size("blocks") < k).select("class")
            done = through if done is None else done.unionByName(through)
            live = live.where(F.size("blocks") >= k).withColumn("cell", F.xxhash64("cell", F.get("blocks", k - 1)))
        cells = written(live.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell"), "cells")  # written so that a hot cell can be split in the join
        live = written(live.join(cells, "cell"), "refined")
    return done.unionByName(live.select("class")).distinct() if done is not None else live.select("class").distinct()


def _class_filter(classes: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the hash of each class, at most MOST_BITS; where bits are shared more texts are compared, never fewer."""
    n = classes.count()
    bits = min(MOST_BITS, max(64, 1 << (BITS_EACH * max(1, n) - 1).bit_length()))
    at = F.pmod("class", F.lit(bits))
    words = classes.groupBy(F.floor(at / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(class, 64) as int))")).alias("set"))
    out = np.zeros(bits // 64, np.uint64)
    for word, set_ in words.toLocalIterator():  # at most MOST_BITS / 64 rows
        out[word] = set_ & 0xFFFFFFFFFFFFFFFF
    return out, bits


def _candidates(words, bits: int):
    """Of (doc_id, text) those whose class may have survived, with the class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        set_ = words.value
        for batch in batches:
            for piece in byte_slices(batch, "text"):
                column = piece.column(1)
                data, cuts = string_bytes(column), string_offsets(column).tolist()
                classes = []
                for a, b in zip(cuts, cuts[1:]):
                    own = bytes(data[a:b])
                    classes.append(_class(_code_points(own), _blocks(memoryview(own))))
                own = np.array(classes, np.int64)
                at = own % bits
                hit = np.flatnonzero(set_[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1))
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(hit)), pa.array(own[hit]), column.take(pa.array(hit))], names=["doc_id", "class", "text"])

    return run


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, mask) of every row; bit k of the mask is set if the row fails filter k of FILTERS.

    A null text counts as empty, a null part as an empty string. A null id is smaller than any other. Rows that repeat
    id and text are no copies of each other, as neither id is smaller. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(part_col, F.lit("")).alias("part"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = written(texts.mapInArrow(_described, f"doc_id {kind}, part string, mask int, length long, blocks array<long>, class long, sha binary"), "described")
    words, bits = _class_filter(written(_surviving(rows), "classes"))
    sent = docs.sparkSession.sparkContext.broadcast(words)
    few = text_rows(docs, id_col, text_col).mapInArrow(_candidates(sent, bits), f"doc_id {kind}, class long, text string")
    each = few.groupBy("class", "text").agg(F.min("doc_id").alias("least"), F.bool_or(F.col("doc_id").isNull()).alias("nameless"), F.count("*").alias("n"))
    equal = written(each.where("n > 1").select("class", F.unhex(F.sha2("text", 256)).alias("sha"), "least", "nameless"), "equal-texts")
    sent.destroy()
    copied = F.coalesce((F.col("doc_id") > F.col("least")) | (F.col("nameless") & F.col("doc_id").isNotNull()), F.lit(False))
    return rows.join(equal, ["class", "sha"], "left").select("doc_id", "part", F.col("mask").bitwiseOR(F.when(copied, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for each part, order of the filters and step; a step's filter is the order's letter at that place.

    kept: after the step; removed: by it; redundant: fail its filter but were removed before; unique_fails: fail its
    filter alone; good_lost, toxic_lost: removed rows that `labels` (doc_id, quality, toxic) marks 1; shapley: what the
    step's filter removes, summed over all orders. Rows without a label count as neither; a label with a null id marks
    nothing, of labels that repeat an id one mark is enough. An empty table has no parts and so no rows.
    """
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    rows = marked(docs, id_col, text_col, part_col).join(written(known, "known"), "doc_id", "left")
    by_mask = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    masks = written(by_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")), "masks")  # at most 32 a part
    orders = F.split(F.lit(",".join("".join(p) for p in itertools.permutations(FILTERS))), ",")
    steps = masks.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bits = F.transform(F.split("filter_order", ""), lambda letter: F.pow(F.lit(2), F.ascii(letter) - ord(FILTERS[0])).cast("int"))
    steps = steps.withColumns({"own": F.get(bits, F.col("step") - 1), "before": F.aggregate(F.slice(bits, 1, F.col("step") - 1), F.lit(0), lambda m, b: m + b)})
    fails, gone = lambda x: x["mask"].bitwiseAND(F.col("own")) != 0, lambda x: x["mask"].bitwiseAND(F.col("before")) != 0
    total = lambda what, when: F.aggregate("masks", F.lit(0).cast("long"), lambda n, x: n + F.when(when(x), x[what]).otherwise(F.lit(0)))
    removed = lambda x: fails(x) & ~gone(x)
    out = steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda x: ~fails(x) & ~gone(x)).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda x: fails(x) & gone(x)).alias("redundant"),
        total("n", lambda x: x["mask"] == F.col("own")).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        "own",
    )
    every = Window.partitionBy("part", "own")  # a row for each order
    return out.withColumn("shapley", F.sum("removed").over(every)).drop("own")
