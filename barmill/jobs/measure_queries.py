"""Queries of measures, labels and table comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.functions import labels as L
from barmill.jobs import oracles as O
from barmill.jobs.bar_queries import metrics, r6, stored
from barmill.jobs.registry import query
from barmill.operators import measures, tablediff
from barmill.operators import metrics as M
from barmill.sources import bars as B


def prices(spark, d) -> DataFrame:
    return measures.prices(stored(spark, d))


def snapshot(spark, d) -> DataFrame:
    own, dim = stored(spark, d), B.dimension(spark, d)
    return measures.snapshot(own, dim, M.stock_metrics(own, dim))


@query("MTH3", O.PRICES, "SELECT ticker, round(from_high_pct, 6) AS from_high_pct, round(from_low_pct, 6) AS from_low_pct FROM priced")
def mth3(spark, d):
    return prices(spark, d).select("ticker", *r6("from_high_pct", "from_low_pct"))


_PERIODS = [f"return_{n}y" for n in (1, 3, 5, 10)]


@query("MTH4", O.PRICES, "SELECT ticker, " + ", ".join(f"round({c}, 6) AS {c}" for c in _PERIODS) + " FROM priced")
def mth4(spark, d):
    return prices(spark, d).select("ticker", *r6(*_PERIODS))


@query("MTH5", O.PRICES, "SELECT ticker, round(return_ytd, 6) AS return_ytd FROM priced")
def mth5(spark, d):
    return prices(spark, d).select("ticker", *r6("return_ytd"))


_ALPHA = ", alphas AS (SELECT p.*, (SELECT return_1y FROM priced WHERE ticker = 'INDEX') AS benchmark_1y, return_1y - (SELECT return_1y FROM priced WHERE ticker = 'INDEX') AS alpha_1y FROM priced p)"


@query("MTH6", O.PRICES + _ALPHA, "SELECT ticker, round(benchmark_1y, 6) AS benchmark_1y, round(alpha_1y, 6) AS alpha_1y FROM alphas")
def mth6(spark, d):
    return snapshot(spark, d).select("ticker", *r6("benchmark_1y", "alpha_1y"))


@query("STG1", O.METRICS, f"SELECT ticker, {O.MISSING_BETA} AS beta_label FROM metrics")
def stg1(spark, d):
    return metrics(spark, d).select("ticker", L.beta_label(F.col("beta")).alias("beta_label"))


@query("STG2", O.METRICS, f"SELECT ticker, {O.SHARPE} AS sharpe_label FROM metrics")
def stg2(spark, d):
    return metrics(spark, d).select("ticker", L.sharpe_label(F.col("sharpe_ratio")).alias("sharpe_label"))


@query("STG3", O.PRICES, f"SELECT ticker, {O.RSI} AS rsi_signal FROM priced")
def stg3(spark, d):
    return prices(spark, d).select("ticker", L.rsi_signal(F.col("rsi")).alias("rsi_signal"))


@query("STG4", O.PRICES, f"SELECT ticker, {O.against(50, 'short-term')} AS price_vs_ma50, {O.against(200, 'long-term')} AS price_vs_ma200 FROM priced")
def stg4(spark, d):
    c = F.col
    return prices(spark, d).select("ticker", L.ma_signal(c("price"), c("ma50"), 50, "short-term").alias("price_vs_ma50"), L.ma_signal(c("price"), c("ma200"), 200, "long-term").alias("price_vs_ma200"))


@query("STG5", O.PRICES, f"SELECT ticker, {O.OVERALL} AS overall_signal FROM priced")
def stg5(spark, d):
    c = F.col
    return prices(spark, d).select("ticker", L.overall_signal(c("price"), c("ma50"), c("ma200"), c("rsi")).alias("overall_signal"))


@query("STG6", O.PRICES + _ALPHA, f"SELECT ticker, {O.BEAT} AS outperform_label, {O.TEN_YEARS} AS return_10y_display, 'Data as of ' || strftime(latest_date, '%d %b %Y') AS last_updated FROM alphas")
def stg6(spark, d):
    return snapshot(spark, d).select("ticker", "outperform_label", "return_10y_display", "last_updated")


_NUMBERS = ["daily_change_pct", "from_high_pct", "from_low_pct", *_PERIODS, "return_ytd", "benchmark_1y", "alpha_1y"]


@query(
    "STG7",
    O.PRICES + _ALPHA + ", snap AS (SELECT a.*, m.beta, m.sharpe_ratio, coalesce(d.company, 'Benchmark index') AS company, coalesce(d.sector, 'Index') AS sector FROM alphas a LEFT JOIN metrics m USING (ticker) LEFT JOIN dim d USING (ticker))",
    "SELECT ticker, company, sector, latest_date, price, previous_close, high_52w, low_52w, beta, sharpe_ratio, rsi, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in _NUMBERS)
    + f", {O.BEAT} AS outperform_label, {O.TEN_YEARS} AS return_10y_display, {O.MISSING_BETA} AS beta_label, {O.SHARPE} AS sharpe_label, {O.RSI} AS rsi_signal, {O.against(50, 'short-term')} AS price_vs_ma50, {O.against(200, 'long-term')} AS price_vs_ma200, {O.OVERALL} AS overall_signal FROM snap",
)
def stg7(spark, d):
    texts = ["outperform_label", "return_10y_display", "beta_label", "sharpe_label", "rsi_signal", "price_vs_ma50", "price_vs_ma200", "overall_signal"]
    return snapshot(spark, d).select("ticker", "company", "sector", "latest_date", "price", "previous_close", "high_52w", "low_52w", "beta", "sharpe_ratio", "rsi", *r6(*_NUMBERS), *texts)


@query("AGG20", O.METRICS, f"SELECT {O.SHARPE} AS sharpe_label, count(*) AS stocks, any_value(q[1]) AS lower, any_value(q[2]) AS median, any_value(q[3]) AS upper FROM metrics, (SELECT quantile_cont(sharpe_ratio, [0.25, 0.5, 0.75]) AS q FROM metrics) GROUP BY 1")
def agg20(spark, d):
    """Stocks per label, beside the quartiles that the thresholds are tuned to."""
    own = metrics(spark, d)
    quartiles = own.agg(F.percentile("sharpe_ratio", F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"))  # one row
    quartiles = quartiles.select(*(F.col("q")[k].alias(c) for k, c in enumerate(("lower", "median", "upper"))))
    return own.groupBy(L.sharpe_label(F.col("sharpe_ratio")).alias("sharpe_label")).agg(F.count("*").alias("stocks")).crossJoin(F.broadcast(quartiles))


def _spent(spark, d) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.groupBy(F.col("o_custkey").alias("customer")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("orders"), F.max("o_orderpriority").alias("priority"))


def before_after(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two exports of a measure table: by rules on the key some values of the second moved, went blank, or lack their row."""
    base, c = _spent(spark, d), F.col("customer")
    after = base.where(c % 13 != 0).withColumns(
        {
            "total": F.when(c % 5 == 0, F.col("total") + 1).when(c % 7 == 0, None).otherwise(F.col("total")),
            "priority": F.when(c % 9 == 0, None).when(c % 8 == 0, "none").otherwise(F.col("priority")),
        }
    )
    return base.where(c % 11 != 0), after


@query(
    "DIF1",
    O.SPENT,
    """SELECT customer, measure, CASE WHEN b IS NOT NULL AND a IS NULL THEN 'went blank' WHEN b IS NULL THEN 'appeared' ELSE 'changed' END AS note
    FROM bm JOIN am USING (customer, measure) WHERE measure <> 'priority' AND ((a IS NULL) <> (b IS NULL) OR abs(a - b) > 1e-9 * greatest(abs(b), 1) + 1e-9)""",
)
def dif1(spark, d):
    return tablediff.changes(*before_after(spark, d), "customer").where("measure <> 'priority'").select("customer", "measure", "note")


@query("DIF2", O.SPENT, "SELECT customer, measure, before, after FROM bm JOIN am USING (customer, measure) WHERE measure = 'priority' AND before IS DISTINCT FROM after")
def dif2(spark, d):
    return tablediff.changes(*before_after(spark, d), "customer").where("measure = 'priority'").select("customer", "measure", "before", "after")


@query(
    "DIF3",
    O.SPENT,
    """SELECT 'row' AS kind, cast(customer AS VARCHAR) AS name, 'failure' AS severity FROM before_ WHERE customer NOT IN (SELECT customer FROM after_)
    UNION ALL SELECT 'row', cast(customer AS VARCHAR), 'warning' FROM after_ WHERE customer NOT IN (SELECT customer FROM before_)
    UNION ALL SELECT 'column', 'orders', 'failure' UNION ALL SELECT 'column', 'n_orders', 'warning'""",
)
def dif3(spark, d):
    """The second export also names a column otherwise."""
    before, after = before_after(spark, d)
    return tablediff.structure(before, after.withColumnRenamed("orders", "n_orders"), "customer")


@query("JOI8", O.SPENT, "SELECT coalesce(bm.customer, am.customer) AS customer, coalesce(bm.measure, am.measure) AS measure, b IS NOT NULL OR (bm.measure = 'priority' AND before IS NOT NULL) AS has_before, a IS NOT NULL OR (am.measure = 'priority' AND after IS NOT NULL) AS has_after FROM bm FULL JOIN am ON bm.customer = am.customer AND bm.measure = am.measure")
def joi8(spark, d):
    both = tablediff.full_comparison(*before_after(spark, d), "customer")
    return both.select("customer", "measure", F.col("before").isNotNull().alias("has_before"), F.col("after").isNotNull().alias("has_after"))


@query("STG8", O.SPENT, "SELECT customer, total, orders FROM before_")
def stg8(spark, d):
    """Headers with a byte order mark and blanks around, as spreadsheets write them."""
    raw = before_after(spark, d)[0].select("customer", "total", "orders").toDF("﻿customer", " total", "orders  ")
    return tablediff.clean_headers(raw).select("customer", "total", "orders")


@query("CST1", O.SPENT, "SELECT measure, count(try_cast(before AS DOUBLE)) >= greatest(1, floor(0.5 * count(*))) AS \"numeric\" FROM bm GROUP BY measure")
def cst1(spark, d):
    return tablediff.numeric_measures(before_after(spark, d)[0], "customer")
