"""Mixing sources to target weights by a low-discrepancy schedule, with DataFrame functions alone.

The mix is a row of slots of equally many words. Slot k has the point frac(k / phi^2) of the golden-ratio sequence, and
the source whose part of the cumulative targets holds the point gets the slot; so every stretch of the mix, not only the
whole, has the sources near their shares. The slots of a source are ranked, and rank r takes block r of the source: its
documents in shuffled order, laid end to end and cut into blocks of a slot's words, begun anew once they are used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.llm.common import written
from barmill.operators.ranking import numbered

WEIGHTS, MOST_PASSES = (1, 2, 3), 3
#: 2^32 / phi^2 to the nearest odd integer: k times this, modulo 2^32, is the golden-ratio sequence mirrored, free of rounding.
GOLDEN, PERIOD = 1640531527, 1 << 32
#: A slot has this part of all words, but no fewer than 1 and no more than MOST_WORDS.
SLOTS, MOST_WORDS = 1 << 20, 4096
#: Slots that one window ranks at most, and documents of a source that one window sums on average, up to MOST_BUCKETS of them.
CHUNK, BUCKET, MOST_BUCKETS = 1 << 16, 1 << 8, 1 << 16


def n_words(text: Column) -> Column:
    """Maximal runs of other characters than blanks, tabs and line ends; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """sources (key, size) with no (their place by key), weight and target.

    Weights repeat in the order of the keys and share all words; a target stops at `most` times its source's size, and
    what is left over goes to the others by weight until none is above. The level of a unit of weight rises with every
    source that is found above its bound, so it is found by a few aggregates.
    """
    own = numbered(sources, [F.col("key")], "no")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int"))
    own = written(own.select("key", "size", "no", weight.alias("weight"), (F.col("size") * most).alias("bound")), "sources")
    level, before = 0.0, None
    while level != before:
        over = F.col("bound") < F.col("weight") * F.lit(level)
        total, held, free = own.agg(F.sum("size"), F.sum(F.when(over, F.col("bound"))), F.sum(F.when(~over, F.col("weight")))).first()
        level, before = ((total or 0) - (held or 0)) / free if free else level, level
    return own.withColumn("target", F.least(F.col("bound").cast("double"), F.col("weight") * F.lit(level)))


def intervals(sources: DataFrame) -> DataFrame:
    """sources (no, target) with lo and hi: their parts of [0, PERIOD), proportional to the targets.

    Targets are summed as whole numbers of a 1024th of a word, so the order of summing changes nothing.
    """
    n = max(1, sources.count())
    groups = min(n, 1 << 12)
    own = sources.withColumns({"group": F.expr(f"no * {groups} div {n}"), "units": F.round(F.col("target") * 1024).cast("long")})
    w = lambda *c: Window.orderBy(*c).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = own.groupBy("group").agg(F.sum("units").alias("sum"))
    sums = sums.withColumn("before", F.sum("sum").over(w("group")) - F.col("sum"))  # at most 4096 rows
    total = sums.agg(F.sum("sum").alias("total"))
    ends = own.withColumn("inside", F.sum("units").over(w("no").partitionBy("group")))
    ends = ends.join(F.broadcast(sums.select("group", "before")), "group").crossJoin(F.broadcast(total))
    place = lambda x: F.when(F.col("total") > 0, F.round(x / F.col("total") * PERIOD)).otherwise(F.lit(0.0)).cast("long")
    end = F.col("before") + F.col("inside")
    return ends.select(*sources.columns, place(end - F.col("units")).alias("lo"), place(end).alias("hi"))


def schedule(sources: DataFrame, n_slots: int) -> DataFrame:
    """(slot, no, rank): the source of each slot and the slot's rank in it.

    Points and the parts of sources meet by cells of the unit interval, so that no slot is compared with all sources.
    """
    spark = sources.sparkSession
    parts = written(intervals(sources.select("no", "target")).where("hi > lo").select("no", "lo", "hi"), "parts")
    cells = 1 << max(10, (2 * parts.count()).bit_length())
    width = PERIOD // cells
    by_cell = parts.select("no", "lo", "hi", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))).alias("cell"))
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), F.pmod(F.pmod("id", F.lit(PERIOD)) * GOLDEN, F.lit(PERIOD)).alias("point"))
    dealt = slots.withColumn("cell", F.expr(f"point div {width}")).join(by_cell, "cell").where("point >= lo and point < hi")
    dealt = written(dealt.select("slot", "no", F.expr(f"slot div {CHUNK}").alias("chunk")), "slots")
    counts = dealt.groupBy("no", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("no", "chunk", (F.sum("n").over(Window.partitionBy("no").orderBy("chunk")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("no", "chunk").orderBy("slot")) - 1
    return dealt.withColumn("inside", inside).join(before, ["no", "chunk"]).select("slot", "no", (F.col("before") + F.col("inside")).alias("rank"))


def laid_out(rows: DataFrame, seed: int) -> DataFrame:
    """rows (no, doc_id, text_key, size, …) with `start`: the words of their source before them, in shuffled order.

    Sums run over buckets of hashes, and over the buckets of a source, of which there are MOST_BUCKETS at most; so a
    source of any size is spread over tasks. Rows that repeat id and text lie beside each other.
    """
    largest = rows.groupBy("no").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(1, largest // BUCKET))
    mixed = F.xxhash64("doc_id", "text_key", F.lit(seed))
    own = rows.withColumns({"mixed": mixed, "bucket": F.pmod(F.shiftright(mixed, 20), F.lit(buckets))})
    sums = own.groupBy("no", "bucket").agg(F.sum("size").alias("sum"))
    before = sums.select("no", "bucket", (F.sum("sum").over(Window.partitionBy("no").orderBy("bucket")) - F.col("sum")).alias("before"))
    w = Window.partitionBy("no", "bucket").orderBy("mixed", "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return own.withColumn("inside", F.sum("size").over(w) - F.col("size")).join(before, ["no", "bucket"]).withColumn("start", F.col("before") + F.col("inside")).drop("mixed", "bucket", "inside", "before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, block_words: int | None = None, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(rows, mixed). rows: doc_id, no, size, source_size, target, start of every row of docs.

    mixed: (slot, pass, no, doc_id, start, first, words): what each slot takes, words [first, first + words) of the row of
    that source and start. A pass is one reading of a source, of which there are `most` at most; slots beyond them stay
    empty. Sources are ordered by their bytes, the null one last. A null text has no words and is never taken, nor is an
    empty one; rows that repeat are taken each. An empty table, or one without words, gives an empty mix.
    """
    key = F.when(F.col(source_col).isNull(), "1").otherwise(F.concat(F.lit("0"), source_col))  # the null source sorts last
    own = written(docs.select(key.alias("key"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), n_words(F.col(text_col)).alias("size")), "sizes")
    sources = written(targets(own.groupBy("key").agg(F.sum("size").alias("size")), weights, most), "targets")
    total = sources.agg(F.sum("size")).first()[0] or 0
    words = block_words or max(1, min(MOST_WORDS, total // SLOTS))
    named = own.join(sources.select("key", "no", F.col("size").alias("source_size"), "target"), "key").drop("key")
    rows = written(laid_out(named, seed), "laid-out")
    slots = schedule(sources, -(-total // words))
    blocks = F.expr(f"(size + {words - 1}) div {words}")
    slots = slots.join(sources.where("size > 0").select("no", blocks.alias("blocks")), "no").select("slot", "no", F.expr("rank div blocks").alias("pass"), (F.col("rank") % F.col("blocks")).alias("block")).where(F.col("pass") < most)
    block = F.explode(F.sequence(F.expr(f"start div {words}"), F.expr(f"(start + size - 1) div {words}"))).alias("block")
    pieces = rows.where("size > 0").select("no", "doc_id", "start", "size", block)
    first = F.greatest(F.col("start"), F.col("block") * words)
    last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * words)
    pieces = pieces.select("no", "block", "doc_id", "start", (first - F.col("start")).alias("first"), (last - first).alias("words"))
    return rows.drop("text_key"), slots.join(pieces, ["no", "block"]).drop("block")


def taken(rows: DataFrame, mixed: DataFrame) -> DataFrame:
    """rows with `taken`: the words that the mix takes of each, repeats counted."""
    each = mixed.groupBy("no", "start").agg(F.sum("words").alias("taken")).select(F.col("no").alias("__no"), F.col("start").alias("__start"), "taken")
    match = (rows["no"] == F.col("__no")) & (rows["start"] == F.col("__start")) & (rows["size"] > 0)
    return rows.join(each, match, "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))).drop("__no", "__start")
