"""Queries of quality checks, coverage, failures and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.jobs import oracles as O
from barmill.jobs.bar_queries import bars, metrics, r6, stored
from barmill.jobs.registry import query
from barmill.operators import cleaning, monitoring, quality
from barmill.operators import metrics as M
from barmill.sources import bars as B
from barmill.sources.shared import shared_dir
from barmill.streaming import bars as S
from barmill.streaming import corrections, upserts

_LATEST = O.BARS + ", latest AS (SELECT ticker, max(date) AS latest FROM bars GROUP BY ticker), mid AS (SELECT quantile_disc(latest, 0.5) AS expected FROM latest)"


@query("AGG12", _LATEST, "SELECT ticker, latest FROM latest")
def agg12(spark, d):
    return monitoring.latest_sessions(bars(spark, d))


@query("AGG13", _LATEST, "SELECT expected FROM mid")
def agg13(spark, d):
    return monitoring.expected_session(monitoring.latest_sessions(bars(spark, d)))


@query(
    "AGG14",
    _LATEST,
    "SELECT expected, count(*) AS total, count(*) FILTER (WHERE latest < expected) AS behind, count(*) FILTER (WHERE latest > expected) AS ahead, count(*) FILTER (WHERE latest >= expected) AS current, round(count(*) FILTER (WHERE latest < expected) * 100.0::DOUBLE / count(*), 6) AS behind_pct FROM latest, mid GROUP BY expected",
)
def agg14(spark, d):
    return monitoring.coverage(monitoring.latest_sessions(bars(spark, d))).select("expected", "total", "behind", "ahead", "current", *r6("behind_pct"))


_COUNTS = (
    O.DIRTY
    + ", days AS (SELECT ticker, date, count(*) AS n, count(*) FILTER (WHERE low <= 0 OR coalesce(close <= 0, false)) AS bad, count(*) FILTER (WHERE close IS NULL) AS empty FROM dirty GROUP BY ticker, date), counts AS (SELECT ticker, cast(sum(n - 1) AS BIGINT) AS duplicate_dates, cast(sum(bad) AS BIGINT) AS non_positive, cast(sum(empty) AS BIGINT) AS null_closes, cast(sum(n) AS BIGINT) AS n_rows FROM days GROUP BY ticker)"
)


@query("AGG15", _COUNTS, "SELECT ticker, duplicate_dates, non_positive, null_closes, n_rows, n_rows = (SELECT min(n_rows) FROM counts) AS smallest, n_rows = (SELECT max(n_rows) FROM counts) AS largest FROM counts")
def agg15(spark, d):
    each = quality.counts_by_ticker(B.dirty_bars(bars(spark, d)))
    ends = each.agg(F.min("n_rows").alias("a"), F.max("n_rows").alias("b"))  # one row
    return each.crossJoin(F.broadcast(ends)).select(*each.columns, (F.col("n_rows") == F.col("a")).alias("smallest"), (F.col("n_rows") == F.col("b")).alias("largest"))


@query(
    "AGG16",
    f"{O.DIRTY}, {O.DIM}",
    "SELECT (SELECT count(*) FROM dirty) AS fact_rows, (SELECT count(DISTINCT ticker) FROM dirty) AS tickers, (SELECT min(date) FROM dirty) AS first_date, (SELECT max(date) FROM dirty) AS last_date, (SELECT count(*) FROM dirty) - (SELECT count(*) FROM bars) AS duplicate_keys, (SELECT count(*) FROM bars) AS part_rows, 0::BIGINT AS duplicate_stocks",
)
def agg16(spark, d):
    own = bars(spark, d)
    return quality.integrity(B.dirty_bars(own), own, B.dimension(spark, d))


_CYCLICAL, _DEFENSIVE = ["ASIA", "AMERICA"], ["EUROPE"]


@query(
    "AGG17",
    O.METRICS,
    "SELECT round(avg(beta) FILTER (WHERE sector IN ('ASIA', 'AMERICA')), 6) AS cyclical, round(avg(beta) FILTER (WHERE sector = 'EUROPE'), 6) AS defensive, round(stddev_samp(beta), 6) AS spread, max(abs(beta)) AS largest, bool_and(beta BETWEEN 0.1 AND 2.5) AS in_range FROM metrics",
)
def agg17(spark, d):
    return quality.beta_plausibility(metrics(spark, d), _CYCLICAL, _DEFENSIVE).select(*r6("cyclical", "defensive", "spread"), "largest", "in_range")


@query("AGG18", O.FIXED, "SELECT round(avg(price_repaired::INT) * 100, 6) AS repair_pct, count(*) FILTER (WHERE price_repaired) AS repairs FROM fixed")
def agg18(spark, d):
    return quality.repair_rate(cleaning.repair_bad_ticks(bars(spark, d)))


_BAD = "status IN ('failed', 'no_data')"
_ISLANDS = O.LOG + f", isles AS (SELECT *, sum(CASE WHEN {_BAD} THEN 0 ELSE 1 END) OVER (PARTITION BY ticker ORDER BY run_id) AS isle FROM log), counted AS (SELECT run_id, ticker, cast(sum(CASE WHEN {_BAD} THEN 1 ELSE 0 END) OVER (PARTITION BY ticker, isle ORDER BY run_id) AS BIGINT) AS in_a_row FROM isles)"


@query(
    "AGG21",
    _ISLANDS + f", shares AS (SELECT run_id, avg(CASE WHEN {_BAD} THEN 1 ELSE 0 END) AS share FROM log GROUP BY run_id)",
    "SELECT run_id, ticker, in_a_row, CASE WHEN share > 0.3 THEN 'systemic' WHEN in_a_row >= 3 THEN 'persistent' ELSE 'transient' END AS kind FROM counted JOIN shares USING (run_id) WHERE in_a_row > 0",
)
def agg21(spark, d):
    return monitoring.failures(B.run_log(spark, d))


@query("AGG22", O.LOG, "SELECT run_id, count(*) AS tickers, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in ("gained", "skipped", "not_final", "failed", "no_data", "ok")) + ", cast(sum(repaired) AS BIGINT) AS repaired FROM log GROUP BY run_id")
def agg22(spark, d):
    return monitoring.run_summary(B.run_log(spark, d))


_MISSED = "cast((SELECT count(*) FROM (SELECT unnest(range(1, 15)) AS i) WHERE i <= later AND isodow(newest + cast(i AS INT)) <= 5) AS BIGINT)"


@query("AGG23", O.BARS, f"SELECT later, newest, {_MISSED} AS weekdays_missed, {_MISSED} > 3 AS alert FROM (SELECT max(date) AS newest FROM bars), (SELECT unnest([2, 5, 11]) AS later)")
def agg23(spark, d):
    """As of some days after the newest bar, fewer and more than may pass."""
    own = bars(spark, d)
    each = [monitoring.staleness(own, F.date_add("newest", n)).select(F.lit(n).alias("later"), "*") for n in (2, 5, 11)]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("AGG24", O.METRICS, "SELECT ticker, data_points FROM metrics WHERE coalesce(data_points, 0) < 1500")
def agg24(spark, d):
    """At a bound that some of the test tables' stocks fall below."""
    return quality.little_history(metrics(spark, d), least=1500).select("ticker", "data_points")


_COPY = "(SELECT 'whole' AS copy, * FROM bars UNION ALL SELECT 'short', * FROM bars WHERE ticker <> 'INDEX')"


@query(
    "AGG25",
    O.BARS + ", a AS (SELECT count(*) AS rows_a, count(DISTINCT ticker) AS tickers_a, max(date) AS newest_a FROM bars)" + f", b AS (SELECT copy, count(*) AS rows_b, count(DISTINCT ticker) AS tickers_b, max(date) AS newest_b FROM {_COPY} GROUP BY copy)",
    "SELECT *, rows_a = rows_b AND tickers_a = tickers_b AND newest_a = newest_b AS same FROM a, b",
)
def agg25(spark, d):
    """A whole copy, and one without the benchmark."""
    own = bars(spark, d)
    copies = {"whole": own.select("*"), "short": own.where(F.col("ticker") != B.BENCHMARK)}
    whole, short = (quality.copy_parity(own, c).withColumn("copy", F.lit(name)) for name, c in copies.items())
    return whole.unionByName(short)


def _near(new: str, old: str, rtol: str, atol: str) -> str:
    return f"coalesce(bool_and(abs({new} - {old}) <= {atol}::DOUBLE + {rtol}::DOUBLE * abs({old})), true)"


_RECHECK = (
    O.STORED
    + f""",
kept AS (SELECT ticker, date, close, ret, rsi_14, ma20, ma50, ma200, bb_upper, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM stored),
anew AS (SELECT *, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS ch, (close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1) * 100 AS r2, """
    + ", ".join(f"CASE WHEN count(close) OVER {O._frame(n)} = {n} THEN avg(close) OVER {O._frame(n)} END AS m{n}" for n in (20, 50, 200))
    + f""", CASE WHEN count(close) OVER {O._frame(20)} = 20 THEN avg(close) OVER {O._frame(20)} + 2 * stddev_samp(close) OVER {O._frame(20)} END AS up FROM kept),
seed2 AS (SELECT ticker, avg(greatest(ch, 0)) AS g, avg(greatest(-ch, 0)) AS l FROM anew WHERE rn BETWEEN 2 AND 15 GROUP BY ticker HAVING count(*) = 14),
wilder2 AS (
  SELECT ticker, 15::BIGINT AS rn, g, l FROM seed2
  UNION ALL
  SELECT m.ticker, m.rn, (w.g * 13 + greatest(m.ch, 0)) / 14, (w.l * 13 + greatest(-m.ch, 0)) / 14 FROM wilder2 w JOIN anew m ON m.ticker = w.ticker AND m.rn = w.rn + 1),
rechecked AS (SELECT a.*, CASE WHEN w.l = 0 THEN 100 ELSE 100 - 100 / (1 + w.g / w.l) END AS rsi2 FROM anew a LEFT JOIN wilder2 w USING (ticker, rn))"""
)


@query(
    "AGG26",
    _RECHECK,
    f"SELECT ticker, {_near('r2', 'ret', '1e-5', '1e-3')} AS return_ok, "
    + ", ".join(f"{_near(f'm{n}', f'ma{n}', '1e-4', '1e-8')} AS ma{n}_ok" for n in (20, 50, 200))
    + f", {_near('rsi2', 'rsi_14', '1e-5', '1e-2')} AS rsi_ok, {_near('up', 'bb_upper', '1e-4', '1e-8')} AS bands_ok FROM rechecked GROUP BY ticker",
)
def agg26(spark, d):
    return quality.indicator_recheck(stored(spark, d))


_SLOPE = "CASE WHEN count(ps) >= 60 THEN regr_slope(ps, pm) END"
_SAME = "coalesce(abs({a} - {b}) <= {tol}::DOUBLE, {a} IS NULL AND {b} IS NULL)"
_WRONG = {"beta": "NATION_3", "sharpe": "NATION_7", "down": "NATION_12"}


@query(
    "AGG27",
    O.MARKET
    + f", both_ AS (SELECT ticker, {O.BY_METRIC['beta']} + CASE WHEN ticker = '{_WRONG['beta']}' THEN 0.5::DOUBLE ELSE 0 END AS beta, {_SLOPE} AS slope, {O.BY_METRIC['sharpe_ratio']} + CASE WHEN ticker = '{_WRONG['sharpe']}' THEN 0.5::DOUBLE ELSE 0 END AS sharpe, "
    + f"{O.BY_METRIC['sharpe_ratio'].replace('round(', '(').replace(', 3)', ')')} AS sharpe2, {O.BY_METRIC['max_drawdown_pct']} - CASE WHEN ticker = '{_WRONG['down']}' THEN 0.5::DOUBLE ELSE 0 END AS down, min(dd) AS down2 FROM peaked GROUP BY ticker)",
    "SELECT ticker, " + ", ".join(f"{_SAME.format(a=a, b=b, tol=tol)} AS {name}" for a, b, tol, name in (("beta", "slope", "0.01", "beta_ok"), ("sharpe", "sharpe2", "0.01", "sharpe_ok"), ("down", "down2", "0.05", "drawdown_ok"))) + " FROM both_",
)
def agg27(spark, d):
    """Metrics as they were stored, one of three stocks each altered before, against others of the bars."""
    path, wrong = shared_dir(spark, "metrics"), lambda k: F.when(F.col("ticker") == _WRONG[k], 0.5).otherwise(0.0)
    altered = metrics(spark, d).withColumns({"beta": F.col("beta") + wrong("beta"), "sharpe_ratio": F.col("sharpe_ratio") + wrong("sharpe"), "max_drawdown_pct": F.col("max_drawdown_pct") - wrong("down")})
    B.write_metrics(altered, path)
    return quality.metric_recheck(stored(spark, d), spark.read.parquet(path))


@query("TOP1", O.METRICS, "(SELECT 'high' AS side, ticker, beta FROM metrics WHERE beta IS NOT NULL ORDER BY beta DESC, ticker LIMIT 3) UNION ALL (SELECT 'low', ticker, beta FROM metrics WHERE beta IS NOT NULL ORDER BY beta, ticker LIMIT 3)")
def top1(spark, d):
    own = metrics(spark, d).where("beta is not null")
    high, low = own.orderBy(F.desc("beta"), "ticker").limit(3), own.orderBy("beta", "ticker").limit(3)
    return high.select(F.lit("high").alias("side"), "ticker", "beta").unionByName(low.select(F.lit("low").alias("side"), "ticker", "beta"))


@query("TOP2", O.FIXED, "SELECT ticker, count(*) AS repairs FROM fixed WHERE price_repaired GROUP BY ticker ORDER BY repairs DESC, ticker LIMIT 8")
def top2(spark, d):
    return cleaning.repair_bad_ticks(bars(spark, d)).where("price_repaired").groupBy("ticker").agg(F.count("*").alias("repairs")).orderBy(F.desc("repairs"), "ticker").limit(8)


@query("TOP3", O.BARS, "SELECT ticker, date, close FROM bars ORDER BY ticker, date")
def top3(spark, d):
    return bars(spark, d).select("ticker", "date", "close").orderBy("ticker", "date")


@query("TOP4", O.BARS, "SELECT ticker, count(*) AS n_rows FROM bars WHERE ticker IN (SELECT DISTINCT ticker FROM bars ORDER BY sha256(ticker || '-7') LIMIT 5) GROUP BY ticker")
def top4(spark, d):
    """A sample of tickers that is the same in every run."""
    own = bars(spark, d)
    sample = own.select("ticker").distinct().orderBy(F.sha2(F.concat("ticker", F.lit("-7")), 256)).limit(5)
    return own.join(F.broadcast(sample), "ticker", "left_semi").groupBy("ticker").agg(F.count("*").alias("n_rows"))


@query("STR1", O.STORED, O.FACT)
def str1(spark, d):
    """Bars up to 2000 land, some of them not final, and the stream runs; then their final versions, the later bars and some look-back that is stored already, and it runs again."""
    landed, table, checkpoint = (shared_dir(spark, n) for n in ("landed", "upserted", "progress"))
    final, open_ = bars(spark, d), (F.dayofmonth("date") == 21) & (F.col("date") < "2001-01-01")
    first = final.where("date < DATE '2001-01-01'").withColumns({"close": F.when(open_, F.col("close") + 1).otherwise(F.col("close")), "source_rank": F.lit(0), "seq": F.lit(0)})
    second = final.where(open_ | (F.col("date") >= "2000-11-01")).withColumns({"source_rank": F.lit(1), "seq": F.lit(1)})
    for rows in (first, second):
        rows.write.mode("append").parquet(landed)
        upserts.upsert_landed(spark, landed, first.schema, table, checkpoint)
    return upserts.current(spark, table).select(*B.FACT_COLUMNS)


def _final(spark, d) -> DataFrame:
    out, checkpoint = shared_dir(spark, "sessions"), shared_dir(spark, "progress")
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").option("recursiveFileLookup", "true").parquet(d)
    days = S.final_sessions(source)
    days.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(days.schema).parquet(out)


@query(
    "STR2",
    None,
    """SELECT cast(ts AS DATE) AS date, event_type AS ticker, round(arg_min(value, row(ts, event_id)), 6) AS open, max(value) AS high, min(value) AS low, round(arg_max(value, row(ts, event_id)), 6) AS close, count(*) AS volume
    FROM events WHERE cast(ts AS DATE) < (SELECT cast(max(ts) AS DATE) FROM events) GROUP BY 1, 2""",
)
def str2(spark, d):
    """The day of the last event is still open, so it is held back."""
    return _final(spark, d).select("date", "ticker", *r6("open"), "high", "low", *r6("close"), "volume")


_BAR = "round(arg_min(value, row(ts, event_id)), 6) AS open, max(value) AS high, min(value) AS low, round(arg_max(value, row(ts, event_id)), 6) AS close, count(*) AS volume"


@query(
    "STR2_late",
    "e AS (SELECT *, cast(ts AS DATE) AS date, event_type AS ticker, cast(ts AS DATE) - DATE '2020-01-01' AS k FROM events), late AS (SELECT * FROM e WHERE (k = 18 AND event_id % 7 = 0) OR (k = 5 AND event_id % 7 = 1))",
    f"SELECT ticker, date, 0 AS version, {_BAR} FROM e WHERE event_id NOT IN (SELECT event_id FROM late) AND k < (SELECT max(k) FROM e) GROUP BY ticker, date "
    f"UNION ALL SELECT ticker, date, 1, {_BAR} FROM e WHERE k = 18 AND ticker IN (SELECT ticker FROM late WHERE k = 18) GROUP BY ticker, date",
)
def str2_late(spark, d):
    """Rows of the 18th day come after it closed and correct it; those of the 5th come too late and are dropped."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    landed, out, checkpoint = (shared_dir(spark, n) for n in ("events", "sessions", "progress"))
    events = spark.read.parquet(f"{d}/events.parquet")
    k, by_seven = F.datediff(F.col("ts").cast("date"), F.lit("2020-01-01").cast("date")), F.col("event_id") % 7
    late = ((k == 18) & (by_seven == 0)) | ((k == 5) & (by_seven == 1))
    for rows in (events.where(~late & (k < 20)), events.where(late | (k >= 20))):
        rows.write.mode("append").parquet(landed)
        days = corrections.corrected_sessions(spark.readStream.schema(events.schema).parquet(landed), late_hours=48)
        days.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(days.schema).parquet(out).select("ticker", "date", "version", *r6("open"), "high", "low", *r6("close"), "volume")


@query("STR3", _ISLANDS, "SELECT ticker, run_id, in_a_row FROM counted")
def str3(spark, d):
    return monitoring.consecutive(B.run_log(spark, d), F.col("status").isin("failed", "no_data"))


@query(
    "STR3_lag",
    O.BARS
    + """, months AS (SELECT ticker, last_day(date) AS run, max(date) AS d FROM bars GROUP BY 1, 2), runs AS (SELECT DISTINCT run FROM months),
    known AS (SELECT r.run, m.ticker, max(m.d) AS latest FROM runs r JOIN months m ON m.run <= r.run GROUP BY 1, 2), middle AS (SELECT run, quantile_disc(latest, 0.5) AS expected FROM known GROUP BY run),
    lagged AS (SELECT cast(year(run) * 12 + month(run) AS BIGINT) AS run_id, ticker, latest < expected AS behind FROM known JOIN middle USING (run)),
    lag_isles AS (SELECT *, sum(CASE WHEN behind THEN 0 ELSE 1 END) OVER (PARTITION BY ticker ORDER BY run_id) AS isle FROM lagged),
    lag_counts AS (SELECT ticker, run_id, cast(sum(behind::INT) OVER (PARTITION BY ticker, isle ORDER BY run_id) AS BIGINT) AS in_a_row FROM lag_isles)""",
    "SELECT ticker, run_id, in_a_row, in_a_row >= 5 AS persistent FROM lag_counts",
)
def str3_lag(spark, d):
    return monitoring.lag_counters(monitoring.lag_log(bars(spark, d)))


@query("STR3_stream", _ISLANDS, "SELECT ticker, cast(arg_max(in_a_row, run_id) AS INT) AS in_a_row, arg_max(in_a_row, run_id) >= 3 AS persistent FROM counted GROUP BY ticker")
def str3_stream(spark, d):
    """The run log lands in two files after each other; keyed state carries the counts over."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    landed, out, checkpoint = (shared_dir(spark, n) for n in ("log", "counters", "progress"))
    log = B.run_log(spark, d)
    for part in (F.col("run_id") < 15, F.col("run_id") >= 15):
        log.where(part).write.mode("append").parquet(landed)
        counters = S.failure_counters(spark.readStream.schema(log.schema).parquet(landed))
        take = lambda rows, batch: rows.withColumn("batch", F.lit(batch)).write.mode("append").parquet(out)
        counters.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(take).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).groupBy("ticker").agg(F.max_by(F.struct("in_a_row", "persistent"), "batch").alias("x")).select("ticker", "x.*")


@query(
    "STR4",
    O.BARS + ", had AS (SELECT * FROM bars WHERE date < DATE '2001-06-01' AND ticker <> 'NATION_12'), land AS (SELECT *, CASE WHEN ticker = 'NATION_3' AND date >= DATE '2001-06-01' THEN NULL ELSE close END AS c FROM bars WHERE date >= DATE '2001-05-01' AND ticker NOT IN ('NATION_15', 'NATION_8')), "
    "a AS (SELECT ticker, max(date) AS last FROM had GROUP BY ticker), b AS (SELECT ticker, max(date) AS raw FROM land GROUP BY ticker), "
    "c AS (SELECT ticker, count(*) FILTER (WHERE last IS NULL OR date > last) AS gained FROM land LEFT JOIN a USING (ticker) WHERE c IS NOT NULL GROUP BY ticker)",
    "SELECT coalesce(a.ticker, b.ticker) AS ticker, CASE WHEN last >= DATE '2001-05-31' THEN 'skipped' WHEN raw IS NULL THEN 'no data' WHEN last IS NULL AND coalesce(gained, 0) > 0 THEN 'created' WHEN coalesce(gained, 0) > 0 THEN '+' || gained || ' rows' WHEN raw > last THEN 'returned but not final' ELSE 'up to date' END AS outcome, coalesce(gained, 0) AS gained FROM a FULL JOIN b ON a.ticker = b.ticker LEFT JOIN c ON c.ticker = coalesce(a.ticker, b.ticker)",
)
def str4(spark, d):
    """A run after 2001-05-31 over bars stored before June, with a new ticker, two without data and one that isn't final."""
    own = bars(spark, d)
    had = own.where("date < DATE '2001-06-01' AND ticker <> 'NATION_12'")
    landed = own.where("date >= DATE '2001-05-01' AND ticker NOT IN ('NATION_15', 'NATION_8')")
    landed = landed.withColumn("close", F.when((F.col("ticker") == "NATION_3") & (F.col("date") >= "2001-06-01"), None).otherwise(F.col("close")))
    return monitoring.outcomes(had, landed, cleaning.drop_open_sessions(landed), F.lit("2001-05-31").cast("date"))
