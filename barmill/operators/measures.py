"""Dashboard measures: one conditional aggregate a ticker, then words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions import labels
from barmill.functions.calendar import months_back
from barmill.functions.numbers import pct
from barmill.operators import chunks
from barmill.operators.metrics import close_at, with_latest
from barmill.operators.ranking import percent_ranks
from barmill.sources.bars import BENCHMARK


def latest_rows(bars: DataFrame, n: int = 1) -> DataFrame:
    """The last n trading rows of each ticker, newest first as n_back = 1."""
    back = F.row_number().over(Window.partitionBy("ticker").orderBy(F.desc("date")))
    return bars.withColumn("n_back", back).where(F.col("n_back") <= n)


def _return(months: int) -> Column:
    """Unrounded; null unless history reaches back to the target."""
    base = close_at(months_back(F.col("__latest"), months))
    return pct(F.max_by("close", "date"), base)


def prices(bars: DataFrame) -> DataFrame:
    """Latest, previous, 52-week, period and year-to-date figures of each ticker, the benchmark included."""
    last = lambda c: F.max_by(c, "date")
    year = F.date_sub(F.col("__latest"), 365)
    base = F.max_by("close", F.when(F.col("date") < F.trunc("__latest", "YEAR"), F.col("date")))
    out = with_latest(bars).groupBy("ticker").agg(
        F.max("date").alias("latest_date"),
        F.min("date").alias("first_date"),
        last("close").alias("price"),
        close_at(F.date_sub("__latest", 1)).alias("previous_close"),
        F.max(F.when(F.col("date") > year, F.col("high"))).alias("high_52w"),
        F.min(F.when(F.col("date") > year, F.col("low"))).alias("low_52w"),
        *(_return(12 * n).alias(f"return_{n}y") for n in (1, 3, 5, 10)),
        pct(last("close"), base).alias("return_ytd"),
        last("rsi_14").alias("rsi"),
        last("ma50").alias("ma50"),
        last("ma200").alias("ma200"),
    )
    price = F.col("price")
    return out.withColumns({"daily_change_pct": pct(price, F.col("previous_close")), "from_high_pct": pct(price, F.col("high_52w")), "from_low_pct": pct(price, F.col("low_52w"))})


def with_identity(rows: DataFrame, dim: DataFrame, company: str = "Benchmark index", sector: str = "Index") -> DataFrame:
    """Company and sector by ticker; what the dimension lacks gets the given names."""
    own = dim.select("ticker", "company", "sector")
    return rows.join(own, "ticker", "left").withColumns({"company": F.coalesce("company", F.lit(company)), "sector": F.coalesce("sector", F.lit(sector))})


def snapshot(bars: DataFrame, dim: DataFrame, metrics: DataFrame, benchmark: str = BENCHMARK) -> DataFrame:
    """Every measure, one row a ticker."""
    own = prices(bars)
    market = own.where(F.col("ticker") == benchmark).select(F.col("return_1y").alias("benchmark_1y"))
    own = own.join(F.broadcast(market), F.lit(True), "left")  # one row
    own = own.withColumn("alpha_1y", F.col("return_1y") - F.col("benchmark_1y"))
    own = with_identity(own, dim).join(metrics.select("ticker", "beta", "sharpe_ratio"), "ticker", "left")
    price, c = F.col("price"), F.col
    return own.withColumns(
        {
            "outperform_label": labels.outperform_label(c("alpha_1y")),
            "return_10y_display": labels.ten_year_display(c("return_10y"), c("first_date")),
            "beta_label": labels.beta_label(c("beta")),
            "sharpe_label": labels.sharpe_label(c("sharpe_ratio")),
            "rsi_signal": labels.rsi_signal(c("rsi")),
            "price_vs_ma50": labels.ma_signal(price, c("ma50"), 50, "short-term"),
            "price_vs_ma200": labels.ma_signal(price, c("ma200"), 200, "long-term"),
            "overall_signal": labels.overall_signal(price, c("ma50"), c("ma200"), c("rsi")),
            "last_updated": labels.data_as_of(c("latest_date")),
        }
    )


def sector_ranks(metrics: DataFrame) -> DataFrame:
    """Rank in the sector by 1-year return and percentile of beta in the universe, the latter by ranges of beta."""
    known = metrics.where("beta is not null").select("ticker", "sector", "return_1y_pct", "beta")
    own = percent_ranks(known, "beta", "beta_percentile")
    in_sector = F.rank().over(Window.partitionBy("sector").orderBy(F.desc_nulls_last("return_1y_pct"))).cast("long")
    return own.select("ticker", "sector", in_sector.alias("rank_in_sector"), "beta_percentile")


def asof_closes(bars: DataFrame, targets: DataFrame) -> DataFrame:
    """(ticker, target, close): the last close at or before each of many targets a ticker; null where there is none.

    Bars and targets are sorted streams of a ticker's months, each of which takes the last close of the months before, so
    no range join is made and a ticker with many rows or targets spreads over tasks.
    """
    kind = lambda k: F.lit(k).alias("__kind")
    both = bars.select("ticker", "date", "close", kind(0)).unionByName(targets.select("ticker", F.col("target").alias("date"), F.lit(None).cast("double").alias("close"), kind(1))).withColumn("__month", chunks.month())
    last = both.groupBy("ticker", "__month").agg(F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("__last"))
    earlier = chunks.carried(last, F.last("__last", ignorenulls=True), "__earlier").drop("__last")
    inside = F.last("close", ignorenulls=True).over(Window.partitionBy("ticker", "__month").orderBy("date", "__kind").rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("__inside", inside).where("__kind = 1").join(earlier, ["ticker", "__month"])
    return found.select("ticker", F.col("date").alias("target"), F.coalesce("__inside", "__earlier").alias("close"))
