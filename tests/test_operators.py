"""Worked examples and edge cases of the bar operators on hand-made frames; the numbers of the examples are fixed values."""

import datetime as dt
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barmill.functions import calendar as C
from barmill.functions import labels as L
from barmill.functions.numbers import round_significant
from barmill.jobs.registry import bar_queries
from barmill.operators import chunks, cleaning, indicators, measures, monitoring, quality, ranking, tablediff
from barmill.operators import metrics as M
from barmill.sources import bars as B
from barmill.sources import yearly
from barmill.streaming import bars as S
from barmill.streaming import corrections, upserts

DAY = dt.date(2020, 1, 1)


def frame(spark, closes, ticker="A", first=DAY):
    rows = [(ticker, first + dt.timedelta(days=k), c, c, c, c, 1) for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume long")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).select(order, name).collect()]


def value(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_spike_is_repaired_and_flagged(spark):
    out = cleaning.repair_bad_ticks(frame(spark, [42.80, 187.09, 43.04]))
    assert column(out, "close") == [42.80, 42.92, 43.04]
    assert column(out, "price_repaired") == [False, True, False]


@pytest.mark.parametrize("closes", [[100.0, 50.0, 50.0], [187.0, 42.8, 43.0], [42.8, 43.0, 187.0]])
def test_level_shift_and_edges_are_not_flagged(spark, closes):
    assert not any(column(cleaning.repair_bad_ticks(frame(spark, closes)), "price_repaired"))


def test_significant_figures(spark):
    rows = spark.createDataFrame([(0.050081,), (0.050145,), (0.050049,), (0.0,), (None,), (123456.7,), (-1.2345678,)], "x double")
    got = [r[0] for r in rows.select(round_significant(F.col("x"))).collect()]
    assert got == [0.050081, 0.050145, 0.050049, 0.0, None, 123457.0, -1.23457]


def test_flat_series_has_rsi_100_after_warm_up(spark):
    assert column(indicators.recursive_indicators(frame(spark, [10.0] * 20)), "rsi_14") == [None] * 14 + [100.0] * 6


def test_short_history_has_no_rsi(spark):
    assert set(column(indicators.recursive_indicators(frame(spark, [1.0 * k for k in range(1, 15)])), "rsi_14")) == {None}


def test_rsi_against_a_plain_loop():
    close = np.random.default_rng(1).uniform(10, 20, 60)
    got = indicators.wilder_rsi(close)
    gains, losses = [max(b - a, 0) for a, b in zip(close, close[1:])], [max(a - b, 0) for a, b in zip(close, close[1:])]
    g, l = sum(gains[:14]) / 14, sum(losses[:14]) / 14
    for k in range(14, 59):
        assert math.isclose(got[k], 100 - 100 / (1 + g / l))
        g, l = (g * 13 + gains[k]) / 14, (l * 13 + losses[k]) / 14


@pytest.mark.parametrize("per_chunk", [5, 14, 40])
def test_chunks_change_no_recursive_indicator(spark, per_chunk):
    close = np.random.default_rng(per_chunk).uniform(10, 20, 90)
    rows = frame(spark, close.tolist()).unionByName(frame(spark, [5.0, 6.0, 4.0], "B"))
    got = indicators.recursive_indicators(rows, per_chunk).where("ticker = 'A'")
    s = [pd.Series(close).ewm(span=n, adjust=False).mean() for n in (12, 26)]
    macd = s[0] - s[1]
    assert np.allclose(column(got, "macd"), macd) and np.allclose(column(got, "macd_signal"), macd.ewm(span=9, adjust=False).mean())
    assert np.allclose(np.array(column(got, "rsi_14"), float), indicators.wilder_rsi(close), equal_nan=True)
    assert np.allclose(np.array(column(got, "macd_hist")), macd - macd.ewm(span=9, adjust=False).mean())


def test_rolling_windows_wait_until_full(spark):
    out = indicators.rolling_indicators(frame(spark, [float(k) for k in range(1, 26)]))
    assert column(out, "ma20")[:19] == [None] * 19 and column(out, "ma20")[19] == 10.5


def test_incremental_equals_full(spark):
    closes = np.random.default_rng(2).uniform(10, 20, 80).tolist()
    rows = frame(spark, closes)
    first = rows.where(F.col("date") < DAY + dt.timedelta(days=50)).withColumns({"source_rank": F.lit(0), "seq": F.lit(0)})
    second = rows.where(F.col("date") >= DAY + dt.timedelta(days=40)).withColumns({"source_rank": F.lit(1), "seq": F.lit(0)})
    again = indicators.add_indicators(cleaning.upsert(first.unionByName(second)))
    assert again.orderBy("date").select(*B.FACT_COLUMNS).collect() == indicators.add_indicators(rows).orderBy("date").select(*B.FACT_COLUMNS).collect()


def test_sixty_pairs_are_enough(spark):
    def beta(n):
        rng = np.random.default_rng(3)
        rows = frame(spark, rng.uniform(9, 11, n + 1).tolist()).unionByName(frame(spark, rng.uniform(9, 11, n + 1).tolist(), B.BENCHMARK))
        return M.ticker_metrics(indicators.add_indicators(rows)).first()["beta"]

    assert beta(59) is None and beta(60) is not None


def test_stock_without_bars_has_a_row(spark):
    dim = spark.createDataFrame([("A", "a", "s"), ("Z", "z", "s")], "ticker string, company string, sector string")
    rows = {r["ticker"]: r for r in M.stock_metrics(indicators.add_indicators(frame(spark, [1.0, 2.0]).unionByName(frame(spark, [1.0, 2.0], B.BENCHMARK))), dim).collect()}
    assert rows["Z"]["data_points"] == 0 and rows["Z"]["beta"] is None and rows["A"]["data_points"] == 2


def test_empty_bars(spark):
    empty = frame(spark, [1.0]).limit(0)
    assert indicators.add_indicators(empty).count() == 0
    assert measures.prices(indicators.add_indicators(empty)).count() == 0


@pytest.mark.parametrize("day, months, expected", [("2023-03-31", 1, "2023-02-28"), ("2024-02-29", 12, "2023-02-28")])
def test_month_ends(spark, day, months, expected):
    assert str(value(spark, C.months_back(F.lit(day).cast("date"), months))) == expected


@pytest.mark.parametrize("a, b, n", [("2024-03-01", "2024-03-04", 1), ("2024-03-01", "2024-03-01", 0), ("2024-03-04", "2024-03-01", 0), ("2024-03-01", "2024-03-11", 6)])
def test_weekdays(spark, a, b, n):
    assert value(spark, C.weekdays_between(F.lit(a).cast("date"), F.lit(b).cast("date"))) == n


@pytest.mark.parametrize("as_of, expected", [("2024-03-04 10:00:00", "2024-03-01"), ("2024-03-04 16:00:00", "2024-03-04"), ("2024-03-03 12:00:00", "2024-03-01"), ("2024-03-02 16:00:00", "2024-03-01")])
def test_newest_session(spark, as_of, expected):
    assert str(value(spark, C.newest_session(F.lit(as_of).cast("timestamp")))) == expected


def test_labels(spark):
    null = F.lit(None).cast("double")
    assert value(spark, L.beta_label(null)) == "Beta not available"
    assert value(spark, L.beta_label(F.lit(1.31))) == "Very high risk - moves 1.31x the market"
    assert value(spark, L.sharpe_label(F.lit(0.0))) == "Underperformed a risk-free deposit"
    assert value(spark, L.rsi_signal(F.lit(70.0))) == "Bullish momentum"
    assert value(spark, L.overall_signal(F.lit(1.0), F.lit(2.0), null, F.lit(60.0))) == "Not enough history for a full signal"
    assert value(spark, L.outperform_label(F.lit(0.0))) == "Beat the index by 0.00%"


@pytest.mark.parametrize("ahead, at, behind, expected", [(9, 42, 0, (0, 9)), (0, 42, 9, (9, 0))])
def test_coverage(spark, ahead, at, behind, expected):
    days = [DAY + dt.timedelta(days=1)] * ahead + [DAY] * at + [DAY - dt.timedelta(days=1)] * behind
    rows = spark.createDataFrame([(str(k), d) for k, d in enumerate(days)], "ticker string, latest date")
    r = monitoring.coverage(rows).first()
    assert (r["behind"], r["ahead"]) == expected and r["current"] == 51 - r["behind"]


def test_expected_session_is_the_lower_median(spark):
    rows = spark.createDataFrame([("a", DAY), ("b", DAY + dt.timedelta(days=1))], "ticker string, latest date")
    assert monitoring.expected_session(rows).first()[0] == DAY


def test_counters_skip_runs_that_did_not_try(spark):
    log = spark.createDataFrame([(1, "a", "failed"), (2, "a", "no_data"), (4, "a", "failed"), (5, "a", "ok"), (6, "a", "failed")], "run_id long, ticker string, status string")
    got = monitoring.consecutive(log, F.col("status").isin("failed", "no_data"))
    assert column(got, "in_a_row", "run_id") == [1, 2, 3, 0, 1]


@pytest.mark.parametrize("failed, kind", [(7, "systemic"), (6, "transient")])
def test_systemic_share(spark, failed, kind):
    log = spark.createDataFrame([(1, str(k), "failed" if k < failed else "ok") for k in range(20)], "run_id long, ticker string, status string")
    assert {r["kind"] for r in monitoring.failures(log).collect()} == {kind}


def test_quarantine_and_missing_columns(spark):
    rows = spark.createDataFrame([("13-01-2020", "1", "1", "1", "1", "1", "bad"), ("2020-01-13", "1", "1", "1", "NaN", "1", "good")], B.LANDED_BARS)
    good, bad = B.quarantine(rows)
    assert [r["ticker"] for r in bad.collect()] == ["bad"]
    assert B.normalise(good).first()["close"] is None
    with pytest.raises(ValueError):
        B.normalise(rows.drop("close"))


def test_blank_text_is_a_change(spark):
    before = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k int, t string, n double")
    after = spark.createDataFrame([(1, None, 1.0 + 1e-12), (2, "y", None)], "k int, t string, n double")
    got = {(r["k"], r["measure"]): r["note"] for r in tablediff.changes(before, after, "k").collect()}
    assert got == {(1, "t"): "changed", (2, "n"): "went blank"}


def test_csv_round_trip(spark, tmp_path):
    rows = frame(spark, [1.0, 2.0])
    rows.select(*(f.name for f in B.RAW_BARS)).write.csv(str(tmp_path / "bars"), header=True)
    assert B.normalise(B.read_bar_files(spark, str(tmp_path / "bars"))).count() == 2


def test_failure_counter_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    landed = str(tmp_path / "log")
    (tmp_path / "log").mkdir()
    schema = "run_id long, ticker string, status string"
    stream = S.failure_counters(spark.readStream.schema(schema).parquet(landed))
    seen = {}
    for rows in ([(1, "a", "failed"), (1, "b", "failed")], [(2, "a", "failed"), (2, "b", "ok")], [(4, "a", "no_data")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        take = stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "progress"))
        take = take.foreachBatch(lambda df, _: seen.update({r["ticker"]: (r["in_a_row"], r["persistent"]) for r in df.collect()}))
        take.trigger(availableNow=True).start().awaitTermination()
    assert seen == {"a": (3, True), "b": (0, False)}


def test_late_rows_correct_a_session_until_its_state_goes(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    landed, out, schema = str(tmp_path / "events"), str(tmp_path / "out"), "ts timestamp, event_id long, event_type string, value double"
    (tmp_path / "events").mkdir()
    at = lambda day, hour: dt.datetime(2020, 1, day, hour)
    lots = [
        [(at(1, 9), 1, "a", 5.0), (at(1, 15), 2, "a", 7.0), (at(2, 9), 3, "a", 6.0), (None, 9, "a", 1.0), (at(2, 9), 10, "a", None)],
        [(at(1, 16), 4, "a", 9.0), (at(3, 1), 5, "a", 4.0)],  # 17 hours late
        [(at(1, 8), 6, "a", 1.0), (at(9, 1), 7, "a", 2.0)],  # beyond the 24 hours
        [(at(3, 2), 8, "a", 3.0), (at(20, 1), 11, "a", 2.0)],
    ]
    for lot in lots:
        spark.createDataFrame(lot, schema).coalesce(1).write.mode("append").parquet(landed)
        days = corrections.corrected_sessions(spark.readStream.schema(schema).parquet(landed), late_hours=24)
        run = days.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start(out)
        run.awaitTermination()
    got = {(r["date"].day, r["version"]): (r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in spark.read.schema(days.schema).parquet(out).collect()}
    assert got == {(1, 0): (5.0, 7.0, 5.0, 7.0, 2), (1, 1): (5.0, 9.0, 5.0, 9.0, 3), (2, 0): (6.0,) * 4 + (1,), (3, 0): (4.0,) * 4 + (1,), (9, 0): (2.0,) * 4 + (1,)}
    assert run.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5  # the open session, its timers and their index


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "A.csv").write_text("Date,close,open,high,low,volume,ticker\n2020-01-01,4,1,3,2,10,A\n\n")
    (tmp_path / "B.csv").write_text("Date,open,high,low,close,volume\n2020-01-01,1,3,2,4,\n2020-01-02,1,3,2,5,7\n")
    (tmp_path / "C.csv").write_text("Date,open,high,low,volume,ticker\n2020-01-01,1,3,2,10,C\n")
    (tmp_path / "D.csv").write_text("Date,open,high,low,close,volume,ticker\n01-02-2020,1,3,2,4,10,D\n")
    files = B.read_bar_files(spark, str(tmp_path))
    good, bad = B.quarantine(files)
    assert {tuple(r) for r in bad.collect()} == {("C", "missing columns: close"), ("D", "dates do not parse")}
    rows = sorted(tuple(r) for r in B.normalise(good).select("ticker", F.dayofmonth("date"), *B.PRICES, "volume").collect())
    assert rows == [("A", 1, 1.0, 3.0, 2.0, 4.0, 10), ("B", 1, 1.0, 3.0, 2.0, 4.0, None), ("B", 2, 1.0, 3.0, 2.0, 5.0, 7)]


def test_quoted_cells(spark, tmp_path):
    (tmp_path / "A.csv").write_text('Date,"Open",high,low,close,volume,ticker,note\n2020-01-01,"1",3,2,"4",10,"A, ""x""","b,c"\n')
    (tmp_path / "B.csv").write_text('Date,note,open,high,low,close,volume\n2020-01-01,"p, q, r",1,3,2,5,7\n')
    files = B.read_bar_files(spark, str(tmp_path))
    got = sorted(tuple(r) for r in B.normalise(files).select("ticker", *B.PRICES, "volume").collect())
    assert got == [('A, "x"', 1.0, 3.0, 2.0, 4.0, 10), ("B", 1.0, 3.0, 2.0, 5.0, 7)]
    assert {tuple(r["missing"]) for r in files.collect()} == {()}
    plan = files._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan


def test_an_upsert_of_a_day_rewrites_its_year(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path), _walk(spark, 900)
    land = lambda df, rank: df.withColumns({"source_rank": F.lit(rank), "seq": F.lit(0)})
    assert yearly.read_years(spark, path) is None
    assert yearly.merge_years(spark, land(rows, 0), path) == [2020, 2021, 2022]
    day = dt.date(2021, 5, 5)
    fixed = rows.where(F.col("date") == day).withColumn("close", F.lit(1.0))
    assert yearly.merge_years(spark, land(fixed, 0), path) == [2021]
    want = sorted((r["date"], 1.0 if r["date"] == day else r["close"]) for r in rows.collect())
    read = lambda: sorted((r["date"], r["close"]) for r in yearly.read_years(spark, path).collect())
    assert read() == want
    assert {(r["version"], r["year"]) for r in spark.read.parquet(f"{path}/bars").select("version", "year").distinct().collect()} == {(0, 2020), (0, 2021), (0, 2022), (1, 2021)}
    with monkeypatch.context() as m:
        m.setattr(yearly, "upsert", lambda df: df.drop("source_rank", "seq").withColumn("close", F.raise_error(F.lit("lost")).cast("double")))
        with pytest.raises(Exception):
            yearly.merge_years(spark, land(fixed, 0), path)
    assert read() == want and yearly.merge_years(spark, land(rows.limit(0), 0), path) == []
    assert {r["year"] for r in yearly.read_years(spark, path, 2022).select(F.year("date").alias("year")).collect()} == {2022}


def test_only_years_that_are_needed_are_read(spark, tmp_path):
    path, rows = str(tmp_path / "bars"), _walk(spark, 900).unionByName(_walk(spark, 800, ticker="B"))
    B.write_bars(rows, path)
    stored = rows.where(F.col("date") < dt.date(2021, 12, 1))
    got = B.read_fresh(spark, path, stored, rows.select("ticker"), days=100)
    assert got.exceptAll(B.fresh_since(rows, stored, days=100).select(got.columns)).isEmpty() and got.count() == B.fresh_since(rows, stored, days=100).count()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 2021", got._jdf.queryExecution().executedPlan().toString())
    fresh = B.read_fresh(spark, path, stored, spark.createDataFrame([("A",), ("NEW",)], "ticker string"), days=100, first="2020-06-01")
    assert fresh.select("ticker").distinct().collect()[0][0] == "A" and fresh.count() == got.where("ticker = 'A'").count()


def _walk(spark, n=260, seed=5, ticker="A"):
    return frame(spark, (100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, 0.01, n)))).tolist(), ticker)


@pytest.mark.parametrize("stored, flag", [("daily_return_pct", "return_ok"), ("ma20", "ma20_ok"), ("ma50", "ma50_ok"), ("ma200", "ma200_ok"), ("rsi_14", "rsi_ok"), ("bb_upper", "bands_ok")])
def test_a_corrupted_indicator_fails_its_recheck(spark, stored, flag):
    fact = indicators.add_indicators(_walk(spark))
    sound = quality.indicator_recheck(fact).first().asDict()
    assert all(v for k, v in sound.items() if k != "ticker")
    last = F.col("date") == F.lit(DAY + dt.timedelta(days=259))
    wrong = quality.indicator_recheck(fact.withColumn(stored, F.when(last, F.col(stored) + 0.05 * F.abs(stored) + 0.02).otherwise(F.col(stored)))).first().asDict()
    assert {k for k, v in wrong.items() if v is False} == {flag}


@pytest.mark.parametrize("stored, flag", [("beta", "beta_ok"), ("sharpe_ratio", "sharpe_ok"), ("max_drawdown_pct", "drawdown_ok")])
def test_a_corrupted_metric_fails_its_recheck(spark, stored, flag):
    fact = indicators.add_indicators(_walk(spark).unionByName(_walk(spark, seed=6, ticker=B.BENCHMARK)))
    metrics = M.ticker_metrics(fact)
    assert all(v for k, v in quality.metric_recheck(fact, metrics).first().asDict().items() if k != "ticker")
    wrong = quality.metric_recheck(fact, metrics.withColumn(stored, F.col(stored) + 0.2)).first().asDict()
    assert {k for k, v in wrong.items() if v is False} == {flag}


def test_little_history(spark):
    rows = spark.createDataFrame([("a", 99), ("b", 100), ("c", None)], "ticker string, data_points long")
    assert sorted(r["ticker"] for r in quality.little_history(rows).collect()) == ["a", "c"]


def test_five_lags_in_a_row_are_persistent(spark):
    months = [dt.date(2020, k, 15) for k in range(1, 9)]
    rows = [(t, d) for t in "abc" for d in months] + [("late", months[0]), ("late", months[6])]
    got = monitoring.lag_counters(monitoring.lag_log(spark.createDataFrame(rows, "ticker string, date date")))
    late = got.where("ticker = 'late'").orderBy("run_id").collect()
    assert [(r["in_a_row"], r["persistent"]) for r in late] == [(0, False), (1, False), (2, False), (3, False), (4, False), (5, True), (0, False), (1, False)]
    assert got.where("ticker <> 'late' and in_a_row > 0").isEmpty()


@pytest.fixture
def hot(spark):
    """A ticker with most of all rows, spikes among them (on a border of chunks of 250 too), one without many, one with a row."""
    closes = (100 * np.exp(np.cumsum(np.random.default_rng(7).normal(0, 0.02, 1300)))).round(2)
    for k in (40, 249, 250, 600, 999, 1298):
        closes[k] *= 3
    return frame(spark, closes.tolist()).unionByName(frame(spark, [5.0, 6.0, 4.0], "B")).unionByName(frame(spark, [1.0], "C"))


def test_a_hot_ticker_s_chunks_give_what_whole_histories_give(spark, hot):
    order = ("ticker", "date")
    rows = lambda df: df.select(*order, *B.PRICES, "price_repaired", *B.INDICATORS).orderBy(*order).toPandas()
    got, want = rows(indicators.unrounded_indicators(hot, rows=250)), rows(indicators.unrounded_indicators(hot))
    assert got["price_repaired"].sum() == want["price_repaired"].sum() > 0
    pd.testing.assert_frame_equal(got, want, rtol=1e-9)
    dealt = chunks.dealt(hot, *indicators.HALO, 250)
    sizes = {(r["ticker"], r["__chunk"]): r["count"] for r in dealt.groupBy("ticker", "__chunk", "__core").count().where("__core").collect()}
    assert sizes == {**{("A", k): 250 for k in range(5)}, ("A", 5): 50, ("B", 0): 3, ("C", 0): 1}
    assert dealt.groupBy("ticker", "__chunk").count().agg(F.max("count")).first()[0] == 250 + 201


def test_flags_at_the_borders_of_chunks(spark, hot):
    flags = lambda df: [r["date"] for r in df.where("price_repaired").orderBy("date").collect()]
    assert flags(cleaning.flag_bad_ticks(hot, rows=250)) == flags(cleaning.flag_bad_ticks(hot))


def test_defining_indicators_starts_no_job(spark, hot):
    spark.sparkContext.setJobGroup("defining", "")
    indicators.add_indicators(hot)
    indicators.recursive_indicators(hot)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("defining")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_drawdown_merges_over_months(spark, hot):
    rows = hot.unionByName(frame(spark, [3.0, None, 2.0, 4.0, 1.0], "D"))
    worst = {}
    for t, own in rows.toPandas().sort_values("date").groupby("ticker"):
        close = own["close"].dropna()
        worst[t] = ((close - close.cummax()) / close.cummax() * 100).min()
    got = {r["ticker"]: r["max_drawdown_pct"] for r in indicators.max_drawdown(rows).collect()}
    assert got == pytest.approx(worst)
    each = {r["ticker"]: r["d"] for r in indicators.drawdown(rows).groupBy("ticker").agg(F.min("drawdown").alias("d")).collect()}
    assert each == pytest.approx(worst)
    assert "Window" not in indicators.max_drawdown(rows)._jdf.queryExecution().optimizedPlan().toString()


def test_figures_that_look_back_against_plain_pandas(spark):
    """A history with gaps, one of a single row, and one whose last row of a month lies before the target's day."""
    rng = np.random.default_rng(8)
    days = [dt.date(2017, 3, 30) + dt.timedelta(days=k) for k in range(1300) if rng.random() < 0.4]
    histories = {"A": days, "B": days[-1:], "C": [dt.date(2018, 1, 31), dt.date(2019, 3, 30), dt.date(2020, 3, 31)]}
    rows = [(t, d, *(float(x) for x in np.sort(rng.uniform(5, 15, 3))), None, None, None) for t, own in histories.items() for d in own]
    bars = spark.createDataFrame(rows, "ticker string, date date, low double, close double, high double, rsi_14 double, ma50 double, ma200 double").repartition(4)
    got = {r["ticker"]: r for r in measures.prices(bars).collect()}
    for ticker, own in pd.DataFrame([r[:5] for r in rows], columns=["ticker", "date", "low", "close", "high"]).groupby("ticker"):
        own = own.set_index(pd.to_datetime(own["date"])).sort_index()
        latest, price = own.index[-1], own["close"].iloc[-1]
        at = lambda target: own["close"][:target].iloc[-1] if len(own["close"][:target]) else None
        change = lambda base: None if base is None else pytest.approx((price / base - 1) * 100)
        for n in (1, 3, 5, 10):
            assert got[ticker][f"return_{n}y"] == change(at(latest - pd.DateOffset(months=12 * n)))
        assert got[ticker]["return_ytd"] == change(at(pd.Timestamp(latest.year - 1, 12, 31)))
        assert got[ticker]["previous_close"] == (own["close"].iloc[-2] if len(own) > 1 else None)
        year = own[own.index > latest - pd.Timedelta(days=365)]
        assert got[ticker]["high_52w"] == year["high"].max() and got[ticker]["low_52w"] == year["low"].min()


def test_rows_meet_the_latest_date_without_a_window_over_a_history(spark, hot):
    """Neither a join by ticker nor a window of rows: aggregates by ticker are combined before their exchange, also if no side is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.with_latest(hot).groupBy("ticker").agg(M.trailing_return(12).alias("r"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = re.findall(r"SortMergeJoin \[ticker#\d+, __month#\d+\]", plan)
    assert joins and plan.count("partial_max_by") > 0
    assert re.search(r"\+- (?:\*\(\d+\) )?Sort \[ticker#\d+ ASC NULLS FIRST, __month#\d+", plan)


def test_rows_without_a_date_have_no_latest_one(spark):
    rows = frame(spark, [1.0, 2.0]).unionByName(frame(spark, [3.0]).withColumn("date", F.lit(None).cast("date")))
    assert sorted(str(r["__latest"]) for r in M.with_latest(rows).collect()) == ["2020-01-02", "2020-01-02", "None"]


def test_warm_up_counts_rows_across_months(spark):
    rows = frame(spark, [1.0] * 70).withColumn("ma50", F.when(F.col("date") >= DAY + dt.timedelta(days=49), 1.0))
    early = rows.withColumn("ma50", F.when(F.col("date") >= DAY + dt.timedelta(days=48), 1.0))
    assert quality.warm_up(rows, 50, "ma50").first()[1:] == (True, True)
    assert quality.warm_up(early, 50, "ma50").first()[1:] == (False, True)


def test_asof_closes_are_carried_over_months(spark):
    rows = frame(spark, [1.0, 2.0, None], "A").unionByName(frame(spark, [7.0], "A", DAY + dt.timedelta(days=200)))
    days = [-1, 0, 1, 2, 60, 199, 200, 900]
    targets = spark.createDataFrame([("A", DAY + dt.timedelta(days=k)) for k in days] + [("Z", DAY)], "ticker string, target date")
    got = {(r["ticker"], r["target"]): r["close"] for r in measures.asof_closes(rows, targets).collect()}
    assert [got["A", DAY + dt.timedelta(days=k)] for k in days] == [None, 1.0, 2.0, 2.0, 2.0, 2.0, 7.0, 7.0] and got["Z", DAY] is None


def test_percent_ranks_share_ties(spark):
    rows = spark.createDataFrame([(k, float(k % 7)) for k in range(100)], "id int, x double").repartition(5)
    want = rows.select("id", F.percent_rank().over(Window.orderBy("x")).alias("p"))
    assert ranking.percent_ranks(rows, "x").select("id", F.col("percent_rank").alias("p")).exceptAll(want).isEmpty()
    assert sorted(r["place"] for r in ranking.numbered(rows, [F.col("x")]).collect()) == list(range(100))


def _landed(rows, rank=0):
    return rows.withColumns({"source_rank": F.lit(rank), "seq": F.lit(0)})


def _fact(df):
    return df.select(*B.FACT_COLUMNS).orderBy("ticker", "date").toPandas()


def test_upserts_go_on_from_stored_state(spark, tmp_path):
    """Days land one after the other, then late corrections, a new ticker and what is stored already; always equal to a full run."""
    table = str(tmp_path / "table")
    rows = _walk(spark, 700).unionByName(_walk(spark, 650, seed=8, ticker="B")).cache()
    upto = lambda n: rows.where(F.col("date") < DAY + dt.timedelta(days=n))
    written = lambda v: spark.read.option("basePath", f"{table}/rows").parquet(f"{table}/rows/version={v}").count()
    same = lambda want: pd.testing.assert_frame_equal(_fact(upserts.current(spark, table)), _fact(indicators.add_indicators(want)), rtol=1e-9)
    upserts.merge(spark, upto(600), table, 0, rows=300)
    assert written(0) == 1200
    upserts.merge(spark, upto(601).where(F.col("date") >= DAY + dt.timedelta(days=350)), table, 2, rows=250)  # 250 days of look-back
    same(upto(601))
    assert written(2) == 4  # a new day of two tickers, and the day before, whose repair looks ahead
    upserts.merge(spark, upto(700).where(F.col("date") >= DAY + dt.timedelta(days=601)), table, 4)
    same(rows)
    late = DAY + dt.timedelta(days=640)
    wrong = F.when((F.col("date") == late) & (F.col("ticker") == "A"), F.col("close") * 3).otherwise(F.col("close"))
    upserts.merge(spark, rows.withColumn("close", wrong).where((F.col("date") == late) & (F.col("ticker") == "A")), table, 6, rows=250)
    same(rows.withColumn("close", wrong))
    assert written(6) == 61  # of one ticker, from the day before on
    upserts.merge(spark, rows.where(F.col("date") == late).unionByName(_walk(spark, 20, seed=9, ticker="C")), table, 8, rows=250)
    whole = rows.unionByName(_walk(spark, 20, seed=9, ticker="C"))
    same(whole)
    upserts.compact(spark, table)
    same(whole)
    assert {r["version"] for r in spark.read.parquet(f"{table}/rows").select("version").distinct().collect()} == {9}
    upserts.merge(spark, rows.where(F.col("date") == late), table, 10)
    same(whole)


def test_an_upsert_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    landed, table, progress = (str(tmp_path / n) for n in ("landed", "table", "progress"))
    rows = _landed(_walk(spark, 30))
    assert upserts.current(spark, table) is None
    rows.write.mode("append").parquet(landed)
    upserts.upsert_landed(spark, landed, rows.schema, table, progress)
    whole = _fact(indicators.add_indicators(_walk(spark, 30)))
    pd.testing.assert_frame_equal(_fact(upserts.current(spark, table)), whole)
    _landed(rows.withColumn("close", F.col("close") + 1), 1).write.mode("append").parquet(landed)
    with monkeypatch.context() as m:
        m.setattr(upserts.I, "rounded", lambda _: 1 / 0)
        with pytest.raises(Exception):
            upserts.upsert_landed(spark, landed, rows.schema, table, progress)
    pd.testing.assert_frame_equal(_fact(upserts.current(spark, table)), whole)
    upserts.upsert_landed(spark, landed, rows.schema, table, progress)
    both = {r["date"]: r["raw_close"] for r in upserts.current(spark, table).collect()}
    assert len(both) == 30 and all(math.isclose(both[r["date"]], r["close"] + 1) for r in _walk(spark, 30).collect())


def test_changed_inputs_give_a_fresh_fact(spark, tmp_path):
    for t in ("lineitem", "supplier", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    first = bar_queries.stored(spark, str(tmp_path))
    assert bar_queries.stored(spark, str(tmp_path)).inputFiles() == first.inputFiles()
    n = first.count()
    spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").where("year(l_shipdate) > 1998").write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    assert 0 < bar_queries.stored(spark, str(tmp_path)).count() < n
