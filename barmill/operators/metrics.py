"""Risk metrics of each ticker against the benchmark: conditional aggregates, and drawdown as a merge of months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions.calendar import months_back
from barmill.operators import chunks
from barmill.operators import indicators as I
from barmill.sources.bars import BENCHMARK

LEAST, TRADING_DAYS, RISK_FREE = 60, 252, 0.065
METRICS = ["beta", "sharpe_ratio", "correlation", "annual_volatility_pct", "max_drawdown_pct", "return_1y_pct", "return_3y_pct", "return_5y_pct", "latest_rsi", "latest_close"]


def with_market(bars: DataFrame, benchmark: str = BENCHMARK) -> DataFrame:
    """Stock rows with market (the benchmark's return of the date) and in_window (from the benchmark's first date on).

    The benchmark has a row a date, so its size is bounded by the calendar and it is broadcast.
    """
    market = bars.where(F.col("ticker") == benchmark).select("date", F.col("daily_return_pct").alias("market"))
    start = market.agg(F.min("date").alias("__start"))
    out = bars.where(F.col("ticker") != benchmark).join(F.broadcast(market), "date", "left").crossJoin(F.broadcast(start))
    return out.withColumn("in_window", F.coalesce(F.col("date") >= F.col("__start"), F.lit(True))).drop("__start")


def paired(value: Column, stock: str = "daily_return_pct", market: str = "market") -> Column:
    """value on rows where both returns are known."""
    return F.when(F.col(stock).isNotNull() & F.col(market).isNotNull(), value)


def _enough(count: Column, value: Column) -> Column:
    return F.when(count >= LEAST, value)


def beta() -> Column:
    stock, market = paired(F.col("daily_return_pct")), paired(F.col("market"))
    return F.round(_enough(F.count(stock), F.try_divide(F.covar_samp(stock, market), F.var_samp(market))), 3)


def beta_by_slope() -> Column:
    stock, market = paired(F.col("daily_return_pct")), paired(F.col("market"))
    return _enough(F.count(stock), F.regr_slope(stock, market))


def correlation() -> Column:
    stock, market = paired(F.col("daily_return_pct")), paired(F.col("market"))
    return F.round(_enough(F.count(stock), F.corr(stock, market)), 3)


def _windowed(column: str = "daily_return_pct") -> Column:
    return F.when(F.col("in_window"), F.col(column))


def sharpe() -> Column:
    excess = _windowed() - RISK_FREE / TRADING_DAYS * 100
    return F.round(_enough(F.count(excess), F.try_divide(F.avg(excess), F.stddev_samp(excess)) * F.sqrt(F.lit(float(TRADING_DAYS)))), 3)


def volatility() -> Column:
    return F.round(_enough(F.count(_windowed()), F.stddev_samp(_windowed()) * F.sqrt(F.lit(float(TRADING_DAYS)))), 2)


def worst_drawdown(rows: DataFrame) -> DataFrame:
    """(ticker, max_drawdown_pct) of rows in the window, from the highest close in the window so far; a merge of months."""
    return I.max_drawdown(rows.withColumn("__close", _windowed("close")), "__close").withColumn("max_drawdown_pct", F.round("max_drawdown_pct", 2))


def with_latest(rows: DataFrame) -> DataFrame:
    """rows with __latest, their ticker's latest date; null where the date is.

    It comes from maxima by month and meets the rows by (ticker, month), so the window reads a row a month, and aggregates
    by ticker that follow are combined before their exchange: a ticker with all rows spreads over tasks.
    """
    own = rows.withColumn("__month", chunks.month())
    months = own.groupBy("ticker", "__month").agg(F.max("date").alias("__latest"))
    latest = F.max("__latest").over(Window.partitionBy("ticker"))
    return own.join(months.withColumn("__latest", latest), ["ticker", "__month"], "left").drop("__month")


def close_at(target: Column) -> Column:
    """Aggregate: the last close at or before target."""
    return F.max_by("close", F.when(F.col("date") <= target, F.col("date")))


def trailing_return(months: int) -> Column:
    base = close_at(months_back(F.col("__latest"), months))
    return F.try_divide(F.max_by("close", "date") - base, base) * 100


def ticker_metrics(bars: DataFrame) -> DataFrame:
    """Every metric, one row a stock that has bars; reads the stored, rounded columns."""
    rows = with_market(bars)
    metrics = with_latest(rows).groupBy("ticker").agg(
        beta().alias("beta"),
        sharpe().alias("sharpe_ratio"),
        correlation().alias("correlation"),
        volatility().alias("annual_volatility_pct"),
        *(F.round(trailing_return(12 * n), 2).alias(f"return_{n}y_pct") for n in (1, 3, 5)),
        F.max_by("rsi_14", F.when(F.col("rsi_14").isNotNull(), F.col("date"))).alias("latest_rsi"),
        F.max_by("close", "date").alias("latest_close"),
        F.max("date").alias("last_date"),
        F.count("*").alias("data_points"),
        F.min(F.when(F.col("in_window"), F.col("date"))).alias("risk_window_start"),
    )
    return metrics.join(worst_drawdown(rows), "ticker")


def stock_metrics(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """ticker_metrics() for every stock of the dimension; those without bars have nulls and no data points."""
    out = dim.select("ticker", "company", "sector").join(ticker_metrics(bars), "ticker", "left")
    return out.withColumn("data_points", F.coalesce("data_points", F.lit(0).cast("long")))


def universe_summary(metrics: DataFrame) -> DataFrame:
    each = [f(c).alias(f"{n}_{c}") for c in ("beta", "sharpe_ratio", "annual_volatility_pct") for n, f in (("min", F.min), ("max", F.max), ("median", F.median))]
    return metrics.agg(*each, F.count("beta").alias("n_beta"), F.count_if(F.col("beta").isNotNull() & F.col("sharpe_ratio").isNotNull()).alias("n_full"))


def volatility_outliers(metrics: DataFrame, times: float = 3.0) -> DataFrame:
    median = metrics.agg(F.median("annual_volatility_pct").alias("median"))  # one row
    return metrics.crossJoin(F.broadcast(median)).where(F.col("annual_volatility_pct") > times * F.col("median")).select("ticker", "annual_volatility_pct", "median")


def sector_rollup(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("sector").agg(F.avg("return_1y_pct").alias("mean_return_1y"), F.avg("beta").alias("mean_beta"), F.count("*").alias("stocks"))
