"""Queries of sources, cleaning, windows, joins and risk metrics."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions import calendar as C
from barmill.functions.numbers import round_significant
from barmill.jobs import oracles as O
from barmill.jobs.registry import query
from barmill.operators import cleaning, measures, quality
from barmill.operators import indicators as I
from barmill.operators import metrics as M
from barmill.sources import bars as B
from barmill.sources import yearly
from barmill.sources.shared import shared_dir


def bars(spark, d) -> DataFrame:
    return B.derived_bars(spark, d)


_FACTS: dict[tuple, str] = {}


def _state_of_inputs(spark, d) -> tuple:
    """What changes when the files that bars are derived from do: their number, and a sum over names, sizes and times."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load([f"{d}/{t}.parquet" for t in ("lineitem", "supplier", "nation")])
    own = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count("*"), F.sum(own)).first())


def stored(spark, d) -> DataFrame:
    """The fact table of these inputs: bars with all indicators, written once in an application for each state of the input files."""
    key = (spark.sparkContext.applicationId, d, _state_of_inputs(spark, d))
    try:
        return spark.read.parquet(_FACTS[key])
    except (KeyError, AnalysisException):  # not written yet, or cleared away
        _FACTS[key] = shared_dir(spark, "fact")
        B.write_fact(I.add_indicators(bars(spark, d)), _FACTS[key])
        return spark.read.parquet(_FACTS[key])


def metrics(spark, d) -> DataFrame:
    return M.stock_metrics(stored(spark, d), B.dimension(spark, d))


def r6(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


def _r6(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


OHLC = "ticker, date, open, high, low, close, volume"


def _landed(spark, d) -> DataFrame:
    return bars(spark, d).select(*(F.col(f.name).cast("string").alias(f.name) for f in B.LANDED_BARS))


def _land(rows: DataFrame, path: str) -> None:
    """CSV files of a ticker each."""
    rows.withColumn("own", F.col("ticker")).repartition("own").write.mode("append").partitionBy("own").csv(path, header=True)


@query("SRC1", O.BARS, f"SELECT {OHLC} FROM bars")
def src1(spark, d):
    """A file of bars a ticker, read into one long table."""
    path = shared_dir(spark, "landed")
    _land(_landed(spark, d), path)
    return B.normalise(B.read_bar_files(spark, path)).select("ticker", "date", *B.PRICES, "volume")


@query("SRC2", O.DIM, "SELECT * FROM dim")
def src2(spark, d):
    path = shared_dir(spark, "dimension")
    B.dimension(spark, d).write.csv(path, header=True)
    return B.read_dimension(spark, path)


@query("SRC3", O.BARS, "SELECT ticker, max(date) AS latest FROM bars GROUP BY ticker")
def src3(spark, d):
    return bars(spark, d).select("ticker", "date").groupBy("ticker").agg(F.max("date").alias("latest"))


@query(
    "SRC4",
    O.BARS,
    f"SELECT {OHLC} FROM bars JOIN (SELECT ticker, max(date) - 500 AS since FROM bars WHERE date < DATE '2000-06-01' GROUP BY ticker) USING (ticker) WHERE date >= since",
)
def src4(spark, d):
    """Stored are the bars before a day; what a run from there on reads of the bars by year."""
    all_bars, path = bars(spark, d), shared_dir(spark, "bars")
    B.write_bars(all_bars, path)
    return B.read_fresh(spark, path, all_bars.where("date < DATE '2000-06-01'"), B.dimension(spark, d).select("ticker").unionByName(spark.sql(f"SELECT '{B.BENCHMARK}' AS ticker"))).select("ticker", "date", *B.PRICES, "volume")


@query(
    "SRC5",
    O.BARS,
    "SELECT ticker, CASE WHEN ticker = 'NATION_2' THEN 'missing columns: close' ELSE 'dates do not parse' END AS reason, count(*) AS n_rows FROM bars WHERE ticker LIKE 'NATION_1%' OR ticker = 'NATION_2' GROUP BY ticker "
    "UNION ALL SELECT 'kept', '', count(*) FROM bars WHERE ticker NOT LIKE 'NATION_1%' AND ticker <> 'NATION_2'",
)
def src5(spark, d):
    """Some tickers have a date that doesn't parse on some days, the file of another lacks a column."""
    landed, path = _landed(spark, d), shared_dir(spark, "landed")
    faulty = landed.withColumn("date", F.when(F.col("ticker").startswith("NATION_1") & F.col("date").endswith("-01"), F.lit("01.01.2000")).otherwise(F.col("date")))
    _land(faulty.where("ticker <> 'NATION_2'"), path)
    _land(faulty.where("ticker = 'NATION_2'").drop("close"), path)
    files = B.read_bar_files(spark, path)
    good, bad = B.quarantine(files)
    kept = good.select(F.lit("kept").alias("ticker"), F.lit("").alias("reason")).groupBy("ticker", "reason").agg(F.count("*").alias("n_rows"))
    return files.join(bad, "ticker").groupBy("ticker", "reason").agg(F.count("*").alias("n_rows")).unionByName(kept)


def _written(spark, name: str, write) -> DataFrame:
    path = shared_dir(spark, name)
    write(path)
    return spark.read.parquet(path)


@query("SNK1", O.BARS, f"SELECT {OHLC} FROM bars")
def snk1(spark, d):
    """Bars written by year, one year written anew, read back."""

    def write(path):
        all_bars = bars(spark, d)
        B.write_bars(all_bars, path)
        B.write_bars(all_bars.where("year(date) = 1999"), path)

    return _written(spark, "bars", write).select("ticker", "date", *B.PRICES, "volume")


@query("SNK2", O.STORED, O.FACT)
def snk2(spark, d):
    return _written(spark, "fact", lambda p: B.write_fact(cleaning.fact_columns(I.add_indicators(bars(spark, d))), p))


@query("SNK3", O.METRICS, "SELECT * FROM metrics")
def snk3(spark, d):
    return _written(spark, "metrics", lambda p: B.write_metrics(metrics(spark, d), p))


@query("FLT1", O.DIRTY, "SELECT ticker, date, close, source_rank FROM dirty WHERE close IS NOT NULL")
def flt1(spark, d):
    return cleaning.drop_open_sessions(B.dirty_bars(bars(spark, d))).select("ticker", "date", "close", "source_rank")


@query("FLT2", O.DIRTY, "SELECT ticker, date, low, close, source_rank FROM dirty WHERE NOT (open <= 0 OR high <= 0 OR low <= 0 OR coalesce(close <= 0, false))")
def flt2(spark, d):
    return cleaning.drop_non_positive(B.dirty_bars(bars(spark, d))).select("ticker", "date", "low", "close", "source_rank")


@query("FLT3", O.BARS, "SELECT ticker, date, close FROM bars WHERE date < DATE '2000-03-01'")
def flt3(spark, d):
    return cleaning.drop_incomplete_session(bars(spark, d), F.lit("2000-03-01 15:29:00").cast("timestamp")).select("ticker", "date", "close")


@query("FLT4", O.BARS, "SELECT ticker, date, close FROM bars WHERE date >= (SELECT min(date) FROM bars WHERE ticker = 'INDEX')")
def flt4(spark, d):
    own = bars(spark, d)
    return cleaning.benchmark_window(own, own.where(F.col("ticker") == B.BENCHMARK)).select("ticker", "date", "close")


@query("FLT5", O.STORED, O.FACT)
def flt5(spark, d):
    return cleaning.fact_columns(stored(spark, d))


@query("FLT6", O.PRICES, "SELECT ticker, high_52w, low_52w FROM priced")
def flt6(spark, d):
    return measures.prices(stored(spark, d)).select("ticker", "high_52w", "low_52w")


@query("FLT7", O.BARS, "SELECT ticker, date, close FROM bars WHERE ticker IN (SELECT n_name FROM nation ORDER BY n_nationkey LIMIT 13) OR ticker = 'NATION_15'")
def flt7(spark, d):
    """One ticker, or the first of the dimension in its order."""
    first = spark.read.parquet(f"{d}/nation.parquet").orderBy("n_nationkey").limit(13).select(F.col("n_name").alias("ticker"))
    chosen = first.unionByName(spark.sql("SELECT 'NATION_15' AS ticker")).distinct()
    return bars(spark, d).join(F.broadcast(chosen), "ticker", "left_semi").select("ticker", "date", "close")


@query("FLT8", f"{O.BARS}, {O.DIM}", "SELECT ticker, date, close FROM bars LEFT JOIN dim USING (ticker) WHERE sector = 'ASIA' OR ticker = 'INDEX'")
def flt8(spark, d):
    return cleaning.sector_role(bars(spark, d), B.dimension(spark, d), "ASIA").select("ticker", "date", "close")


@query("FLT9", O.FIXED, "SELECT ticker, date, close FROM fixed WHERE price_repaired")
def flt9(spark, d):
    """Flags as text, as they come out of a text file."""
    flagged = cleaning.repair_bad_ticks(bars(spark, d)).withColumn("price_repaired", F.initcap(F.col("price_repaired").cast("string")))
    return flagged.where(F.col("price_repaired").cast("boolean")).select("ticker", "date", "close")


@query("FLT10", O.STORED, "SELECT ticker, count(*) FILTER (WHERE abs(ret) > 25) AS big_moves FROM stored GROUP BY ticker")
def flt10(spark, d):
    return quality.indicator_flags(stored(spark, d)).select("ticker", "big_moves")


@query("FLT11", O.STORED, "SELECT ticker, bool_and(rsi_14 BETWEEN 0 AND 100) AS rsi_ok, bool_and(s20 >= 0) AS bands_ok FROM stored GROUP BY ticker")
def flt11(spark, d):
    return quality.indicator_flags(stored(spark, d)).select("ticker", "rsi_ok", "bands_ok")


@query("FLT12", O.BARS, f"SELECT {OHLC} FROM bars")
def flt12(spark, d):
    """Landed rows of another shape: a first column of another name, a NaN, a ticker from outside."""
    landed = bars(spark, d).select(F.col("date").alias("Day"), "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"), F.col("ticker").alias("name"))
    return B.normalise(landed, F.col("name")).select("ticker", "date", *B.PRICES, "volume")


@query("JOI1", O.MARKET, "SELECT ticker, date, ret, m AS market FROM joined WHERE ret IS NOT NULL AND m IS NOT NULL")
def joi1(spark, d):
    rows = M.with_market(stored(spark, d)).where("daily_return_pct is not null and market is not null")
    return rows.select("ticker", "date", F.col("daily_return_pct").alias("ret"), "market")


@query("JOI2", O.BARS, "SELECT x.ticker, x.target, bars.close FROM (SELECT DISTINCT b.ticker, t.target FROM (SELECT DISTINCT ticker FROM bars) b, (SELECT unnest([DATE '1994-01-01', DATE '1996-02-29', DATE '1999-12-31', DATE '2001-01-07']) AS target) t) x ASOF LEFT JOIN bars ON x.ticker = bars.ticker AND x.target >= bars.date")
def joi2(spark, d):
    own = bars(spark, d)
    dates = spark.sql("SELECT explode(array(DATE '1994-01-01', DATE '1996-02-29', DATE '1999-12-31', DATE '2001-01-07')) AS target")
    targets = own.select("ticker").distinct().crossJoin(F.broadcast(dates))  # four rows
    return measures.asof_closes(own, targets)


@query("JOI3", O.METRICS, "SELECT ticker, company, data_points, latest_close FROM metrics")
def joi3(spark, d):
    return metrics(spark, d).select("ticker", "company", "data_points", "latest_close")


@query("JOI4", f"{O.BARS}, {O.DIM}", "SELECT DISTINCT ticker, coalesce(company, 'Benchmark index') AS company, coalesce(sector, 'Index') AS sector FROM bars LEFT JOIN dim USING (ticker)")
def joi4(spark, d):
    return measures.with_identity(bars(spark, d).select("ticker").distinct(), B.dimension(spark, d))


@query("JOI5", O.PRICES, "SELECT p.ticker, price, beta, sharpe_ratio FROM priced p LEFT JOIN metrics USING (ticker)")
def joi5(spark, d):
    own = stored(spark, d)
    return measures.prices(own).join(M.stock_metrics(own, B.dimension(spark, d)).select("ticker", "beta", "sharpe_ratio"), "ticker", "left").select("ticker", "price", "beta", "sharpe_ratio")


@query(
    "JOI6",
    O.BARS,
    "SELECT ticker, count(*) AS n_common, count(*) FILTER (WHERE abs(close - other) <= 1e-8 + 1e-4 * abs(other)) AS n_close FROM (SELECT ticker, close, CASE WHEN day(date) % 2 = 0 THEN close * 1.00005 ELSE close * 1.001 END AS other FROM bars WHERE day(date) <> 3) GROUP BY ticker",
)
def joi6(spark, d):
    own = bars(spark, d)
    other = own.where("day(date) <> 3").withColumn("close", F.when(F.dayofmonth("date") % 2 == 0, F.col("close") * 1.00005).otherwise(F.col("close") * 1.001))
    return quality.reconcile(own, other, rtol=1e-4)


@query("JOI7", f"{O.BARS}, {O.DIM}", "SELECT ticker, 'missing' AS gap FROM dim WHERE ticker NOT IN (SELECT ticker FROM bars WHERE ticker <> 'NATION_3') UNION ALL SELECT 'EXTRA', 'unexpected'")
def joi7(spark, d):
    own = bars(spark, d).where("ticker <> 'NATION_3'").select("ticker").unionByName(spark.sql("SELECT 'EXTRA' AS ticker"))
    return quality.inventory_gaps(own, B.dimension(spark, d))


def _metric(name: str, columns: dict[str, str]):
    """Registers a query of single metrics, by aggregates that are combined before their exchange."""
    sql = ", ".join(f"{O.BY_METRIC[v]} AS {k}" for k, v in columns.items())
    return query(name, O.MARKET, f"SELECT ticker, {sql} FROM peaked GROUP BY ticker")


def _by_ticker(spark, d, *aggregates) -> DataFrame:
    return M.with_market(stored(spark, d)).groupBy("ticker").agg(*aggregates)


@_metric("AGG1", {"beta": "beta"})
def agg1(spark, d):
    return _by_ticker(spark, d, M.beta().alias("beta"))


@_metric("AGG2", {"slope": "slope"})
def agg2(spark, d):
    return _by_ticker(spark, d, F.round(M.beta_by_slope(), 6).alias("slope"))


@_metric("AGG3", {"correlation": "correlation"})
def agg3(spark, d):
    return _by_ticker(spark, d, M.correlation().alias("correlation"))


@_metric("AGG4", {"sharpe_ratio": "sharpe_ratio"})
def agg4(spark, d):
    return _by_ticker(spark, d, M.sharpe().alias("sharpe_ratio"))


@_metric("AGG5", {"annual_volatility_pct": "annual_volatility_pct"})
def agg5(spark, d):
    return _by_ticker(spark, d, M.volatility().alias("annual_volatility_pct"))


@_metric("AGG6", {"max_drawdown_pct": "max_drawdown_pct"})
def agg6(spark, d):
    return M.worst_drawdown(M.with_market(stored(spark, d)))


@_metric("AGG7", {f"return_{n}y_pct": f"return_{n}y_pct" for n in (1, 3, 5)})
def agg7(spark, d):
    return M.with_latest(M.with_market(stored(spark, d))).groupBy("ticker").agg(*(F.round(M.trailing_return(12 * n), 2).alias(f"return_{n}y_pct") for n in (1, 3, 5)))


_LAST = ("latest_rsi", "latest_close", "last_date", "data_points", "risk_window_start")


@_metric("AGG8", {c: c for c in _LAST})
def agg8(spark, d):
    return M.ticker_metrics(stored(spark, d)).select("ticker", *_LAST)


@query("AGG9", O.METRICS, "SELECT * FROM metrics")
def agg9(spark, d):
    return metrics(spark, d)


_THREE = ("beta", "sharpe_ratio", "annual_volatility_pct")


@query("AGG10", O.METRICS, "SELECT " + ", ".join(f"{f}({c}) AS {f}_{c}" for c in _THREE for f in ("min", "max", "median")) + ", count(beta) AS n_beta, count(*) FILTER (WHERE beta IS NOT NULL AND sharpe_ratio IS NOT NULL) AS n_full FROM metrics")
def agg10(spark, d):
    return M.universe_summary(metrics(spark, d))


@query("AGG11", O.METRICS, "SELECT ticker, annual_volatility_pct, median FROM metrics, (SELECT median(annual_volatility_pct) AS median FROM metrics) WHERE annual_volatility_pct > 1.2 * median")
def agg11(spark, d):
    return M.volatility_outliers(metrics(spark, d), times=1.2)


@query("AGG19", O.METRICS, "SELECT sector, round(avg(return_1y_pct), 6) AS mean_return_1y, round(avg(beta), 6) AS mean_beta, count(*) AS stocks FROM metrics GROUP BY sector")
def agg19(spark, d):
    return M.sector_rollup(metrics(spark, d)).select("sector", *r6("mean_return_1y", "mean_beta"), "stocks")


@query("WIN1", O.FIXED, "SELECT ticker, date, round((close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1) * 100, 4) AS daily_return_pct FROM fixed")
def win1(spark, d):
    return I.repaired_rolling(bars(spark, d)).select("ticker", "date", F.round("daily_return_pct", 4).alias("daily_return_pct"))


@query("WIN2", O.ROLLED, f"SELECT ticker, date, {_r6('ma20', 'ma50', 'ma200')} FROM rolled")
def win2(spark, d):
    return I.repaired_rolling(bars(spark, d)).select("ticker", "date", *r6("ma20", "ma50", "ma200"))


_BANDS = "round(ma20 + 2 * s20, 5) AS bb_upper, round(ma20 - 2 * s20, 5) AS bb_lower, round(4 * s20 / ma20 * 100, 4) AS bb_width"


@query("WIN3", O.ROLLED, f"SELECT ticker, date, {_BANDS} FROM rolled")
def win3(spark, d):
    return I.repaired_rolling(bars(spark, d)).select("ticker", "date", F.round("bb_upper", 5).alias("bb_upper"), F.round("bb_lower", 5).alias("bb_lower"), F.round("bb_width", 4).alias("bb_width"))


@query("WIN4", O.FIXED, "SELECT ticker, date, price_repaired FROM fixed")
def win4(spark, d):
    return cleaning.flag_bad_ticks(bars(spark, d)).select("ticker", "date", "price_repaired")


@query("WIN5", O.FIXED, "SELECT ticker, date, open, high, low, close FROM fixed WHERE price_repaired")
def win5(spark, d):
    return cleaning.repair_bad_ticks(bars(spark, d)).where("price_repaired").select("ticker", "date", *B.PRICES)


@query("WIN6", O.RECURSIVE, "SELECT ticker, date, round(rsi, 4) AS rsi_14 FROM full_")
def win6(spark, d):
    return I.recursive_indicators(cleaning.repair_bad_ticks(bars(spark, d))).select("ticker", "date", F.round("rsi_14", 4).alias("rsi_14"))


@query("WIN7", O.RECURSIVE, f"SELECT ticker, date, {_r6('macd', 'macd_signal', 'macd_hist')} FROM full_")
def win7(spark, d):
    return I.recursive_indicators(cleaning.repair_bad_ticks(bars(spark, d))).select("ticker", "date", *r6("macd", "macd_signal", "macd_hist"))


@query("WIN8", O.FIXED, "SELECT ticker, date, round((close - max(close) OVER w) / max(close) OVER w * 100, 6) AS drawdown FROM fixed WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)")
def win8(spark, d):
    return I.drawdown(cleaning.repair_bad_ticks(bars(spark, d))).select("ticker", "date", F.round("drawdown", 6).alias("drawdown"))


@query("WIN9", O.PRICES, "SELECT ticker, price, previous_close, round(daily_change_pct, 6) AS daily_change_pct FROM priced")
def win9(spark, d):
    return measures.prices(stored(spark, d)).select("ticker", "price", "previous_close", *r6("daily_change_pct"))


@query("WIN10", O.BARS, "SELECT ticker, date, close, n_back FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n_back FROM bars) WHERE n_back <= 3")
def win10(spark, d):
    return measures.latest_rows(bars(spark, d), 3).select("ticker", "date", "close", F.col("n_back").cast("long").alias("n_back"))


@query("WIN11", O.BARS, "SELECT ticker, count(*) FILTER (WHERE down) AS n_down FROM (SELECT ticker, coalesce(date < lag(date) OVER (PARTITION BY ticker ORDER BY volume, date), false) AS down FROM bars) GROUP BY ticker")
def win11(spark, d):
    """Rows stored in the order of their volumes."""
    seq = F.row_number().over(Window.partitionBy("ticker").orderBy("volume", "date"))
    return quality.out_of_order(bars(spark, d).withColumn("seq", seq))


@query("WIN12", O.ROLLED, "SELECT ticker, coalesce(bool_and(ma50 IS NULL) FILTER (WHERE rn < 50), true) AS empty_before, coalesce(bool_or(ma50 IS NOT NULL) FILTER (WHERE rn >= 50), false) AS known_after FROM rolled GROUP BY ticker")
def win12(spark, d):
    return quality.warm_up(stored(spark, d), 50, "ma50")


@query(
    "WIN13",
    O.METRICS,
    "SELECT ticker, sector, rank() OVER (PARTITION BY sector ORDER BY return_1y_pct DESC NULLS LAST) AS rank_in_sector, round(percent_rank() OVER (ORDER BY beta), 6) AS beta_percentile FROM metrics WHERE beta IS NOT NULL",
)
def win13(spark, d):
    return measures.sector_ranks(metrics(spark, d)).select("ticker", "sector", "rank_in_sector", *r6("beta_percentile"))


_ALL = "ticker, date, open, high, low, close, volume, price_repaired"


@query("WIN14", O.RECURSIVE, f"SELECT {_ALL}, round(ret, 4) AS daily_return_pct, {_r6('ma20', 'ma50', 'ma200', 'macd', 'macd_signal', 'macd_hist')}, round(rsi, 4) AS rsi_14, {_BANDS} FROM full_")
def win14(spark, d):
    """Everything in order, before the last rounding of price-like columns, whose ties fall either way."""
    out = I.unrounded_indicators(bars(spark, d))
    return out.select("ticker", "date", *B.PRICES, "volume", "price_repaired", *r6("ma20", "ma50", "ma200", "macd", "macd_signal", "macd_hist"), *(F.round(c, n).alias(c) for c, n in (("daily_return_pct", 4), ("rsi_14", 4), ("bb_upper", 5), ("bb_lower", 5), ("bb_width", 4))))


@query("SET1", O.BARS, "SELECT ticker, date, close FROM bars WHERE ticker < 'G' UNION ALL SELECT ticker, date, close FROM bars WHERE ticker >= 'G'")
def set1(spark, d):
    own = bars(spark, d).select("ticker", "date", "close")
    return own.where("ticker < 'G'").unionByName(own.where("ticker >= 'G'"))


@query("SET2", O.DIRTY, "SELECT ticker, date, open, high, low, close, volume FROM dirty QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY source_rank DESC, seq DESC) = 1")
def set2(spark, d):
    """First versions land, then the second ones, merged by year."""
    landed, path = B.dirty_bars(bars(spark, d)), shared_dir(spark, "merged")
    for rank in (0, 1):
        yearly.merge_years(spark, landed.where(F.col("source_rank") == rank), path)
    return yearly.read_years(spark, path).select("ticker", "date", *B.PRICES, "volume")


@query("SET3", O.BARS, "SELECT ticker, count(*) AS gained FROM bars WHERE date >= DATE '2001-01-01' GROUP BY ticker")
def set3(spark, d):
    own = bars(spark, d)
    return cleaning.new_rows(own, own.where("date < DATE '2001-01-01'"))


@query("SET4", f"{O.BARS}, {O.DIM}", "SELECT 'a' AS side, ticker FROM (SELECT ticker FROM bars EXCEPT SELECT ticker FROM dim) UNION ALL SELECT 'b', ticker FROM (SELECT ticker FROM dim EXCEPT SELECT ticker FROM bars) UNION ALL SELECT 'common', cast(date AS VARCHAR) FROM (SELECT date FROM bars WHERE ticker = 'NATION_12' INTERSECT SELECT date FROM bars WHERE ticker = 'NATION_15')")
def set4(spark, d):
    own, dim = bars(spark, d), B.dimension(spark, d).select("ticker")
    names = own.select("ticker")
    common = own.where("ticker = 'NATION_12'").select("date").intersect(own.where("ticker = 'NATION_15'").select("date"))
    side = lambda df, s: df.select(F.lit(s).alias("side"), F.col(df.columns[0]).cast("string").alias("ticker"))
    return side(names.subtract(dim), "a").unionByName(side(dim.subtract(names), "b")).unionByName(side(common, "common"))


@query("MTH1", None, f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, {O.sig6('l_extendedprice')} AS six FROM lineitem")
def mth1(spark, d):
    return spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", round_significant(F.col("l_extendedprice")).alias("six"))


@query("MTH2", O.BARS, "SELECT ticker, date, round(close / open, 4) AS four, round(high / low, 3) AS three, round(close / low, 2) AS two FROM bars")
def mth2(spark, d):
    c = F.col
    return bars(spark, d).select("ticker", "date", F.round(c("close") / c("open"), 4).alias("four"), F.round(c("high") / c("low"), 3).alias("three"), F.round(c("close") / c("low"), 2).alias("two"))


@query("DAT1", O.BARS, "SELECT ticker, date, cast(year(date) AS INT) AS year, cast(month(date) AS INT) AS month, cast(quarter(date) AS INT) AS quarter, strftime(date, '%Y-%m') AS year_month FROM bars")
def dat1(spark, d):
    return bars(spark, d).select("ticker", "date", *(v.alias(k) for k, v in C.date_parts().items()))


@query("DAT2", O.BARS, "SELECT DISTINCT date, cast(date - INTERVAL 1 MONTH AS DATE) AS one, cast(date - INTERVAL 12 MONTH AS DATE) AS twelve FROM bars")
def dat2(spark, d):
    return bars(spark, d).select("date").distinct().select("date", C.months_back(F.col("date"), 1).alias("one"), C.months_back(F.col("date"), 12).alias("twelve"))


@query(
    "DAT3",
    None,
    """SELECT event_id, CASE isodow(c) WHEN 6 THEN c - 1 WHEN 7 THEN c - 2 ELSE c END AS session FROM (
      SELECT event_id, CASE WHEN isodow(ts) <= 5 AND hour(ts) * 60 + minute(ts) >= 930 THEN cast(ts AS DATE) ELSE cast(ts AS DATE) - 1 END AS c FROM events)""",
)
def dat3(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", C.newest_session(F.col("ts")).alias("session"))


@query(
    "DAT4",
    O.BARS,
    "SELECT ticker, cast((SELECT count(*) FROM (SELECT unnest(range(1, greatest(1, (last - first) + 1))) AS i) WHERE isodow(first + cast(i AS INT)) <= 5) AS BIGINT) AS weekdays FROM (SELECT ticker, min(date) AS first, max(date) AS last FROM bars GROUP BY ticker)",
)
def dat4(spark, d):
    span = bars(spark, d).groupBy("ticker").agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return span.select("ticker", C.weekdays_between(F.col("a"), F.col("b")).cast("long").alias("weekdays"))


@query(
    "DAT5",
    O.BARS,
    "SELECT date, cast(year(date) AS INT) AS year, cast(month(date) AS INT) AS month, cast(quarter(date) AS INT) AS quarter, strftime(date, '%Y-%m') AS year_month FROM (SELECT cast(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM bars)",
)
def dat5(spark, d):
    return C.date_dimension(bars(spark, d))


@query("DAT6", None, "SELECT event_id, isodow(ts) <= 5 AND hour(ts) * 60 + minute(ts) BETWEEN 555 AND 929 AS open_now FROM events")
def dat6(spark, d):
    return spark.read.parquet(f"{d}/events.parquet").select("event_id", C.market_open(F.col("ts")).alias("open_now"))
