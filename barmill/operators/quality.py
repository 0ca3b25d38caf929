"""Checks of stored bars, metrics and copies of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.operators import chunks
from barmill.operators import indicators as I
from barmill.operators import metrics as M
from barmill.sources.bars import BENCHMARK, PRICES


def counts_by_ticker(bars: DataFrame) -> DataFrame:
    """Duplicate dates, non-positive prices, null closes and rows of each ticker, in one pass."""
    bad = F.coalesce(F.least(*PRICES) <= 0, F.lit(False))
    by_day = bars.groupBy("ticker", "date").agg(F.count("*").alias("n"), F.count_if(bad).alias("bad"), F.count_if(F.col("close").isNull()).alias("empty"))
    return by_day.groupBy("ticker").agg(F.sum(F.col("n") - 1).alias("duplicate_dates"), F.sum("bad").alias("non_positive"), F.sum("empty").alias("null_closes"), F.sum("n").alias("n_rows"))


def quality_totals(bars: DataFrame) -> DataFrame:
    each = counts_by_ticker(bars)
    first = F.struct("n_rows", "ticker")
    return each.agg(F.sum("n_rows").alias("total"), F.min_by("ticker", first).alias("smallest"), F.max_by("ticker", first).alias("largest"), F.sum("duplicate_dates").alias("duplicate_dates"), F.sum("null_closes").alias("null_closes"))


def integrity(fact: DataFrame, parts: DataFrame, dim: DataFrame) -> DataFrame:
    """Row counts of the fact against its parts, span, and repeated keys: one row."""
    keys = fact.groupBy("ticker", "date").agg(F.count("*").alias("n"))
    a = keys.agg(F.sum("n").alias("fact_rows"), F.count_distinct("ticker").alias("tickers"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum(F.col("n") - 1).alias("duplicate_keys"))
    b = parts.agg(F.count("*").alias("part_rows"))
    c = dim.groupBy("ticker").agg(F.count("*").alias("n")).agg(F.sum(F.col("n") - 1).alias("duplicate_stocks"))
    return a.crossJoin(F.broadcast(b)).crossJoin(F.broadcast(c))  # a row each


def indicator_flags(bars: DataFrame) -> DataFrame:
    """RSI within bounds, bands in order, and implausible daily moves, by ticker."""
    return bars.groupBy("ticker").agg(
        F.bool_and(F.col("rsi_14").between(0, 100)).alias("rsi_ok"), F.bool_and(F.col("bb_upper") >= F.col("bb_lower")).alias("bands_ok"), F.count_if(F.abs("daily_return_pct") > 25).alias("big_moves")
    )


def warm_up(bars: DataFrame, n: int, column: str) -> DataFrame:
    """Whether a moving average is null on a ticker's first n-1 rows, and known on some later one."""
    rows = chunks.placed(bars).withColumn("__row", F.col("__place") + 1)
    return rows.groupBy("ticker").agg(
        F.coalesce(F.bool_and(F.when(F.col("__row") < n, F.col(column).isNull())), F.lit(True)).alias("empty_before"), F.coalesce(F.bool_or(F.when(F.col("__row") >= n, F.col(column).isNotNull())), F.lit(False)).alias("known_after")
    )


def out_of_order(rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Rows whose date lies below that of the row stored before, by ticker."""
    before = F.lag("date").over(Window.partitionBy("ticker").orderBy(seq))
    return rows.withColumn("__down", F.coalesce(F.col("date") < before, F.lit(False))).groupBy("ticker").agg(F.count_if("__down").alias("n_down"))


def close_to(a: Column, b: Column, rtol: float, atol: float = 1e-8) -> Column:
    return F.abs(a - b) <= atol + rtol * F.abs(b)


def reconcile(left: DataFrame, right: DataFrame, column: str = "close", rtol: float = 1e-9) -> DataFrame:
    """By ticker: dates that both have, and on how many the values agree within the tolerance."""
    other = right.select("ticker", "date", F.col(column).alias("__other"))
    both = left.select("ticker", "date", column).join(other, ["ticker", "date"])
    return both.groupBy("ticker").agg(F.count("*").alias("n_common"), F.count_if(close_to(F.col(column), F.col("__other"), rtol)).alias("n_close"))


def inventory_gaps(bars: DataFrame, dim: DataFrame, benchmark: str = BENCHMARK) -> DataFrame:
    """(ticker, gap): expected tickers without bars are missing, others are unexpected."""
    present = bars.select("ticker").distinct()
    expected = dim.select("ticker").unionByName(dim.sparkSession.sql(f"SELECT '{benchmark}' AS ticker")).distinct()
    return expected.join(present, "ticker", "left_anti").withColumn("gap", F.lit("missing")).unionByName(present.join(expected, "ticker", "left_anti").withColumn("gap", F.lit("unexpected")))


def beta_plausibility(metrics: DataFrame, cyclical: list[str], defensive: list[str]) -> DataFrame:
    group = lambda s: F.avg(F.when(F.col("sector").isin(s), F.col("beta")))
    return metrics.agg(group(cyclical).alias("cyclical"), group(defensive).alias("defensive"), F.stddev_samp("beta").alias("spread"), F.max(F.abs("beta")).alias("largest"), F.bool_and(F.col("beta").between(0.1, 2.5)).alias("in_range"))


def repair_rate(bars: DataFrame) -> DataFrame:
    return bars.agg(F.round(F.avg(F.col("price_repaired").cast("boolean").cast("int")) * 100, 6).alias("repair_pct"), F.count_if(F.col("price_repaired").cast("boolean")).alias("repairs"))


def copy_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows, tickers and newest date of two copies side by side, and whether they agree."""
    one = lambda d, s: d.agg(F.count("*").alias(f"rows_{s}"), F.count_distinct("ticker").alias(f"tickers_{s}"), F.max("date").alias(f"newest_{s}"))
    return one(a, "a").crossJoin(F.broadcast(one(b, "b"))).withColumn("same", (F.col("rows_a") == F.col("rows_b")) & (F.col("tickers_a") == F.col("tickers_b")) & (F.col("newest_a") == F.col("newest_b")))


def little_history(metrics: DataFrame, least: int = 100) -> DataFrame:
    """Stocks with fewer bars than `least`; unknown counts are none."""
    return metrics.where(F.coalesce("data_points", F.lit(0)) < least)


def indicator_recheck(bars: DataFrame) -> DataFrame:
    """By ticker, whether stored indicators agree with those computed anew from the stored close; pairs with a null are passed over.

    Tolerances: averages and the upper band a ten-thousandth, returns 0.001, RSI 0.01 beside the usual hundred-thousandth.
    """
    stored = ("daily_return_pct", "ma20", "ma50", "ma200", "bb_upper", "rsi_14")
    again = {"r": I.daily_return(), "m20": I.moving_average(20), "m50": I.moving_average(50), "m200": I.moving_average(200), "up": I.bollinger()["bb_upper"]}
    kept = bars.select("ticker", "date", "close", *(F.col(c).alias(f"stored_{c}") for c in stored))
    rows = I.with_recursive(kept, again)
    ok = lambda new, c, rtol, atol: F.coalesce(F.bool_and(close_to(F.col(new), F.col(f"stored_{c}"), rtol, atol)), F.lit(True))
    return rows.groupBy("ticker").agg(
        ok("r", "daily_return_pct", 1e-5, 1e-3).alias("return_ok"),
        *(ok(f"m{n}", f"ma{n}", 1e-4, 1e-8).alias(f"ma{n}_ok") for n in (20, 50, 200)),
        ok("rsi_14", "rsi_14", 1e-5, 1e-2).alias("rsi_ok"),
        ok("up", "bb_upper", 1e-4, 1e-8).alias("bands_ok"),
    )


def metric_recheck(bars: DataFrame, metrics: DataFrame) -> DataFrame:
    """By ticker, whether stored metrics agree with others of the bars, over the benchmark window.

    Beta is recomputed as a slope, Sharpe from sums and sums of squares, and drawdown from the running peak of every row.
    """
    rows = I.drawdown(M.with_market(bars).withColumn("__close", F.when(F.col("in_window"), F.col("close"))), "__close")
    x = F.when(F.col("in_window"), F.col("daily_return_pct"))
    n, mean = F.count(x), F.sum(x) / F.count(x)
    spread = F.sqrt((F.sum(x * x) - F.sum(x) * mean) / (n - 1))
    sharpe = F.when(n >= M.LEAST, F.try_divide(mean - M.RISK_FREE / M.TRADING_DAYS * 100, spread) * F.sqrt(F.lit(float(M.TRADING_DAYS))))
    new = rows.groupBy("ticker").agg(M.beta_by_slope().alias("b"), sharpe.alias("s"), F.min("drawdown").alias("d"))
    near = lambda stored, again, tol: F.coalesce(F.abs(F.col(stored) - F.col(again)) <= tol, F.col(stored).isNull() & F.col(again).isNull())
    return metrics.select("ticker", "beta", "sharpe_ratio", "max_drawdown_pct").join(new, "ticker").select("ticker", near("beta", "b", 0.01).alias("beta_ok"), near("sharpe_ratio", "s", 0.01).alias("sharpe_ok"), near("max_drawdown_pct", "d", 0.05).alias("drawdown_ok"))
