"""Row filters, upserts and bad-tick repair of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from barmill.functions import calendar
from barmill.functions.numbers import round_significant
from barmill.operators import chunks
from barmill.sources.bars import BENCHMARK, FACT_COLUMNS, PRICES


def by_date(*within: str) -> WindowSpec:
    return Window.partitionBy(*(within or ("ticker",))).orderBy("date")


def drop_open_sessions(bars: DataFrame) -> DataFrame:
    """A session without a close isn't final."""
    return bars.where(F.col("close").isNotNull())


def drop_non_positive(bars: DataFrame) -> DataFrame:
    """Rows with a price of zero or less go; a missing price alone doesn't drop a row."""
    return bars.where(~F.coalesce(F.col("open") <= 0, F.lit(False)) & ~F.coalesce(F.col("high") <= 0, F.lit(False)) & ~F.coalesce(F.col("low") <= 0, F.lit(False)) & ~F.coalesce(F.col("close") <= 0, F.lit(False)))


def drop_incomplete_session(bars: DataFrame, as_of: Column) -> DataFrame:
    """Before the close of as_of, rows of that day are left out."""
    return bars.where((calendar.minute_of_day(as_of) >= calendar.CLOSE) | (F.col("date") < F.to_date(as_of)))


def benchmark_window(rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows from the benchmark's first date on; all of them without a benchmark."""
    start = benchmark.agg(F.min("date").alias("__start"))  # one row
    return rows.crossJoin(F.broadcast(start)).where(F.col("__start").isNull() | (F.col("date") >= F.col("__start"))).drop("__start")


def fact_columns(bars: DataFrame) -> DataFrame:
    return bars.select(*FACT_COLUMNS)


def sector_role(fact: DataFrame, dim: DataFrame, sector: str, benchmark: str = BENCHMARK) -> DataFrame:
    """Rows that a reader of one sector may see: that sector's and the benchmark's."""
    own = dim.where(F.col("sector") == sector).select("ticker")
    return fact.where(F.col("ticker") == benchmark).unionByName(fact.where(F.col("ticker") != benchmark).join(own, "ticker", "left_semi"))


def upsert(rows: DataFrame, keys: tuple[str, ...] = ("ticker", "date")) -> DataFrame:
    """One row a key: of the highest source_rank, then the highest seq."""
    last = Window.partitionBy(*keys).orderBy(F.desc("source_rank"), F.desc("seq"))
    return rows.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n", "source_rank", "seq")


def new_rows(merged: DataFrame, stored: DataFrame) -> DataFrame:
    """(ticker, gained): rows later than the last stored date; all rows of a ticker that wasn't stored."""
    last = stored.groupBy("ticker").agg(F.max("date").alias("__last"))
    later = merged.join(last, "ticker", "left").where(F.col("__last").isNull() | (F.col("date") > F.col("__last")))
    return later.groupBy("ticker").agg(F.count("*").alias("gained"))


def flags(bars: DataFrame, jump: float = 0.40, revert: float = 0.20, within: tuple[str, ...] = chunks.WITHIN) -> DataFrame:
    """bars with price_repaired, __before and __after (the closes beside each), of rows that were dealt with a halo."""
    w, close = by_date(*within), F.col("close")
    before, after = F.lag("close").over(w), F.lead("close").over(w)
    move = lambda a, b: F.abs(F.try_divide(a, b) - 1)
    bad = (move(close, before) > jump) & (move(close, after) > jump) & (move(after, before) < revert)
    return bars.withColumns({"__before": before, "__after": after, "price_repaired": F.coalesce(bad, F.lit(False))})


def repaired(bars: DataFrame, jump: float = 0.40, revert: float = 0.20, within: tuple[str, ...] = chunks.WITHIN) -> DataFrame:
    """Rows that flags() finds are scaled so that their close is the mean of the raw neighbours' closes."""
    factor = (F.col("__before") + F.col("__after")) / 2 / F.col("close")
    fixed = {c: F.when(F.col("price_repaired"), round_significant(F.col(c) * factor)).otherwise(F.col(c)) for c in PRICES}
    return flags(bars, jump, revert, within).withColumns(fixed).drop("__before", "__after")


def flag_bad_ticks(bars: DataFrame, jump: float = 0.40, revert: float = 0.20, rows: int = chunks.ROWS) -> DataFrame:
    """price_repaired: the close jumps away from both neighbours while these agree. The first and last row never are."""
    return chunks.core(flags(chunks.dealt(bars, 1, 1, rows), jump, revert).drop("__before", "__after"))


def repair_bad_ticks(bars: DataFrame, jump: float = 0.40, revert: float = 0.20, rows: int = chunks.ROWS) -> DataFrame:
    """Flagged rows are scaled so that their close is the mean of the raw neighbours' closes."""
    return chunks.core(repaired(chunks.dealt(bars, 1, 1, rows), jump, revert))
