"""Coverage, staleness and failures of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions.calendar import weekdays_between


def latest_sessions(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.max("date").alias("latest"))


def expected_session(latest: DataFrame) -> DataFrame:
    """The lower median of the tickers' latest dates, one row."""
    middle = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date(latest))")
    return latest.agg(F.date_from_unix_date(middle.cast("int")).alias("expected"))


def coverage(latest: DataFrame) -> DataFrame:
    """Tickers behind and ahead of the expected session; those ahead count as current."""
    both = latest.crossJoin(F.broadcast(expected_session(latest)))  # one row
    behind = F.count_if(F.col("latest") < F.col("expected"))
    total = F.count("*")
    return both.agg(F.max("expected").alias("expected"), total.alias("total"), behind.alias("behind"), F.count_if(F.col("latest") > F.col("expected")).alias("ahead"), (total - behind).alias("current"), (behind / total * 100).alias("behind_pct"))


def staleness(bars: DataFrame, as_of: Column, most: int = 3) -> DataFrame:
    newest = bars.agg(F.max("date").alias("newest"))
    missed = weekdays_between(F.col("newest"), as_of).cast("long")
    return newest.withColumn("weekdays_missed", missed).withColumn("alert", F.col("weekdays_missed") > most)


def consecutive(log: DataFrame, bad: Column, name: str = "in_a_row") -> DataFrame:
    """(ticker, run_id, in_a_row): bad runs in a row up to each run that tried the ticker; runs that didn't leave it unchanged."""
    w = Window.partitionBy("ticker").orderBy("run_id")
    rows = log.select("ticker", "run_id", bad.cast("int").alias("__bad")).withColumn("__island", F.sum(1 - F.col("__bad")).over(w))
    return rows.withColumn(name, F.sum("__bad").over(Window.partitionBy("ticker", "__island").orderBy("run_id"))).drop("__bad", "__island")


def failures(log: DataFrame, most_share: float = 0.30, persistent: int = 3) -> DataFrame:
    """(run_id, ticker, kind) of failed tickers: systemic if too many fail in the run, else persistent or transient by their count in a row.

    Counts go on in runs that are refused as systemic.
    """
    bad = F.col("status").isin("failed", "no_data")
    share = log.groupBy("run_id").agg(F.avg(bad.cast("int")).alias("share"))
    counted = consecutive(log, bad).where("in_a_row > 0").join(share, "run_id")
    kind = F.when(F.col("share") > most_share, "systemic").when(F.col("in_a_row") >= persistent, "persistent").otherwise("transient")
    return counted.select("run_id", "ticker", "in_a_row", kind.alias("kind"))


def lag_log(bars: DataFrame) -> DataFrame:
    """(run_id, ticker, behind) of a coverage report at the end of every month: whether a ticker's newest bar is older than the expected session.

    Tickers count from their first bar on. Months are few, so their list is broadcast.
    """
    month = F.last_day("date")
    each = bars.groupBy("ticker", month.alias("run")).agg(F.max("date").alias("latest"))
    runs = each.select("run").distinct()
    grid = each.select("ticker").distinct().crossJoin(F.broadcast(runs))
    newest = F.max("latest").over(Window.partitionBy("ticker").orderBy("run").rowsBetween(Window.unboundedPreceding, 0))
    known = grid.join(each, ["ticker", "run"], "left").withColumn("latest", newest).where("latest is not null")
    expected = known.groupBy("run").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date(latest))").cast("int").alias("expected"))
    both = known.join(expected, "run")
    return both.select((F.year("run") * 12 + F.month("run")).cast("long").alias("run_id"), "ticker", (F.unix_date("latest") < F.col("expected")).alias("behind"))


def lag_counters(log: DataFrame, persistent: int = 5) -> DataFrame:
    """(ticker, run_id, in_a_row, persistent): reports in a row that found a ticker behind; one that is current clears the count."""
    return consecutive(log, F.col("behind")).withColumn("persistent", F.col("in_a_row") >= persistent)


def run_summary(log: DataFrame) -> DataFrame:
    """A row a run: tickers tried, how many came to each outcome, and the bars repaired in all (log.repaired; a null counts as none)."""
    outcome = [F.count_if(F.col("status") == s).alias(s) for s in ("gained", "skipped", "not_final", "failed", "no_data", "ok")]
    return log.groupBy("run_id").agg(F.count("*").alias("tickers"), *outcome, F.coalesce(F.sum("repaired"), F.lit(0)).alias("repaired"))


def outcomes(stored: DataFrame, landed: DataFrame, clean: DataFrame, newest: Column) -> DataFrame:
    """(ticker, outcome, gained) of a run: skipped, created, gained, up to date, returned but not final, or no data.

    stored: bars before the run; landed: what the source gave; clean: what of it is final.
    """
    a = stored.groupBy("ticker").agg(F.max("date").alias("last"))
    b = landed.groupBy("ticker").agg(F.max("date").alias("raw"))
    c = clean.join(a, "ticker", "left").groupBy("ticker").agg(F.count_if(F.col("last").isNull() | (F.col("date") > F.col("last"))).alias("gained"))
    rows = a.join(b, "ticker", "full_outer").join(c, "ticker", "left").withColumn("gained", F.coalesce("gained", F.lit(0).cast("long")))
    text = (
        F.when(F.col("last") >= newest, "skipped")
        .when(F.col("raw").isNull(), "no data")
        .when(F.col("last").isNull() & (F.col("gained") > 0), "created")
        .when(F.col("gained") > 0, F.concat(F.lit("+"), F.col("gained").cast("string"), F.lit(" rows")))
        .when(F.col("raw") > F.col("last"), "returned but not final")
        .otherwise("up to date")
    )
    return rows.select("ticker", text.alias("outcome"), "gained")
