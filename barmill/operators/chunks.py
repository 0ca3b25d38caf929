"""Histories cut into chunks of rows, so that a ticker with many rows spreads over tasks.

A row's place in its ticker's history is its place in its month behind the rows of the months before, which come from
counts by month; no window spans a history. Chunks are runs of so many places, and rows near a border are copied to the
neighbouring chunk as its halo, so that windows of a bounded reach are exact within a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a chunk, and what windows within a chunk are grouped by.
ROWS = 4096
WITHIN = ("ticker", "__chunk")


def month(date: str = "date") -> Column:
    return F.year(date) * 12 + F.month(date)


def carried(parts: DataFrame, value: Column, name: str) -> DataFrame:
    """parts (ticker, __month, …) with an aggregate of the months before each; a row a month, so a ticker's are few."""
    return parts.withColumn(name, value.over(Window.partitionBy("ticker").orderBy("__month").rowsBetween(Window.unboundedPreceding, -1)))


def placed(bars: DataFrame) -> DataFrame:
    """bars with __place, from 0 in each ticker's order of dates; rows without a ticker or a date have none and are left out."""
    own = bars.withColumn("__month", month())
    counts = own.groupBy("ticker", "__month").agg(F.count("*").alias("__n"))
    before = carried(counts, F.sum("__n"), "__before").select("ticker", "__month", F.coalesce("__before", F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("ticker", "__month").orderBy("date")) - 1
    return own.withColumn("__inside", inside).join(before, ["ticker", "__month"]).withColumn("__place", F.col("__before") + F.col("__inside")).drop("__month", "__before", "__inside")


def dealt(bars: DataFrame, before: int, after: int = 0, rows: int = ROWS) -> DataFrame:
    """bars with __place, __chunk and __core: each chunk's own rows, and a halo of the rows next to it that aren't core."""
    if max(before, after) > rows:
        raise ValueError("a halo may not be longer than a chunk")
    chunk, at = F.expr(f"__place div {rows}"), F.col("__place") % rows
    also = [F.when(at >= rows - before, chunk + 1), F.when((at < after) & (chunk > 0), chunk - 1)]
    own = placed(bars).withColumn("__own", chunk)
    out = own.withColumn("__chunk", F.explode(F.array_compact(F.array(chunk, *also))))
    return out.withColumn("__core", F.col("__chunk") == F.col("__own")).drop("__own")


def core(rows: DataFrame) -> DataFrame:
    """The rows that were dealt, without halos."""
    return rows.where("__core").drop("__place", "__chunk", "__core")
