"""A table of bars with all indicators that landed files are merged into, each batch reading and writing only what it reaches.

Every row keeps the raw bar, the fact's columns, its place in the ticker's history and the state of the recursions behind
it. A batch finds the first date of each ticker that changes; from the row before it on (its repair looks one row ahead)
rows are computed anew, the recursions from the state stored behind the row before those, the windows from the last 200
rows. They become a new version; the log says from which date on it holds, so older versions keep the dates before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barmill.operators import chunks
from barmill.operators import indicators as I
from barmill.operators.cleaning import repaired, upsert
from barmill.sources.bars import FACT_COLUMNS, PRICES

RAW = [*PRICES, "volume"]
#: Rows before the first one to compute that are read: the halo of the windows, and the row whose state is taken.
REACH = I.HALO[0] + 2


def _log(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """(version, ticker, since, year, n): from which date on a version holds a ticker, and the rows that it has since in each year."""
    try:
        log = spark.read.parquet(f"{table}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return log if before is None else log.where(F.col("version") < before)


def _rows(spark: SparkSession, table: str, log: DataFrame) -> DataFrame:
    """All stored columns of the rows that hold: those before the date from which on any later version holds."""
    each = log.groupBy("ticker", "version").agg(F.min("since").alias("since"))
    later = Window.partitionBy("ticker").orderBy(F.desc("version")).rowsBetween(Window.unboundedPreceding, -1)
    ends = each.select("ticker", "version", F.min("since").over(later).alias("__end"))
    rows = spark.read.option("basePath", f"{table}/rows").parquet(f"{table}/rows").join(ends, ["ticker", "version"])
    return rows.where(F.col("__end").isNull() | (F.col("date") < F.col("__end"))).drop("__end")


def current(spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
    """The newest state of every row: the fact's columns and the raw bars (raw_close, …); None if nothing was merged yet. before: of versions below."""
    log = _log(spark, table, before)
    if log is None or log.isEmpty():
        return None
    return _rows(spark, table, log).select(*FACT_COLUMNS, *(f"raw_{c}" for c in RAW))


def _years(log: DataFrame, touched: DataFrame) -> DataFrame:
    """(ticker, first_year): the year from which on at least REACH rows lie before the year of `first`, the ticker's first landed date."""
    counts = log.groupBy("ticker", "year").agg(F.max_by("n", "version").alias("n"))
    back = Window.partitionBy("ticker").orderBy(F.desc("year")).rowsBetween(Window.unboundedPreceding, -1)
    earlier = counts.join(touched, "ticker").where(F.col("year") < F.year("first")).withColumn("nearer", F.coalesce(F.sum("n").over(back), F.lit(0)))
    need = earlier.where(F.col("nearer") < REACH).groupBy("ticker").agg(F.min("year").alias("first_year"))
    return touched.join(need, "ticker", "left").select("ticker", F.coalesce("first_year", F.year("first")).alias("first_year"))


def merge(spark: SparkSession, fresh: DataFrame, table: str, version: int, rows: int = chunks.ROWS) -> None:
    """Merges bars (date, open, high, low, close, volume, ticker; one row a key) into the table as a version above all others.

    Rows that are stored as they land change nothing. A merge that fails leaves the table as it was, as readers go by the
    log, which is written last; one that is run again writes the same version. Rows without a ticker or date are left out.
    """
    fresh = fresh.where("ticker is not null and date is not null").select("ticker", "date", *(F.col(c).alias(f"raw_{c}") for c in RAW))
    log = _log(spark, table, version)
    stored = [*(f"raw_{c}" for c in RAW), "fixed_close", "place", *I.STATE]
    region = None
    if log is not None:
        years = _years(log, fresh.groupBy("ticker").agg(F.min("date").alias("first"))).persist()
        first = years.agg(F.min("first_year")).first()[0]
        region = _rows(spark, table, log).where(F.col("year") >= F.lit(first or 0)).join(years, "ticker").where(F.col("year") >= F.col("first_year")).select("ticker", "date", *stored)
    if region is None:
        region = spark.createDataFrame([], "ticker string, date date").select("ticker", "date", *(F.lit(None).cast("long" if c in ("raw_volume", "place") else "double").alias(c) for c in stored))
    both = region.withColumn("__stored", F.lit(True)).join(fresh.select("ticker", "date", F.struct(*(f"raw_{c}" for c in RAW)).alias("landed")), ["ticker", "date"], "full_outer")
    held = F.struct(*(f"raw_{c}" for c in RAW))
    changed = F.col("landed").isNotNull() & (F.col("__stored").isNull() | ~held.eqNullSafe(F.col("landed")))
    both = both.withColumn("__changed", F.when(changed, F.col("date"))).persist()
    # from the row before the first change on; __place - place is how many rows lie before what was read
    starts = both.groupBy("ticker").agg(F.min("__changed").alias("__first"), F.min("place").alias("__read")).where("__first is not null")
    since = both.join(starts, "ticker").groupBy("ticker").agg(F.coalesce(F.max(F.when(F.col("date") < F.col("__first"), F.col("date"))), F.min("__first")).alias("since"), F.coalesce(F.min("__read"), F.lit(0)).alias("__read")).persist()
    raw = {f"raw_{c}": F.coalesce(F.col(f"landed.raw_{c}"), F.when(F.col("landed").isNull(), F.col(f"raw_{c}"))) for c in RAW}
    own = both.join(since, "ticker").withColumns(raw).withColumn("__known", F.col("date") < F.col("since"))
    own = own.select("ticker", "date", *(F.col(f"raw_{c}").alias(c) for c in RAW), *(f"raw_{c}" for c in RAW), "__known", "since", "__read", "fixed_close", *I.STATE)
    dealt = chunks.dealt(own, *I.HALO, rows)
    fixed = repaired(dealt)
    fixed = fixed.withColumn("close", F.when(F.col("__known"), F.col("fixed_close")).otherwise(F.col("close"))).drop("fixed_close")
    found = I.recursive(I.rolling(fixed.withColumns({"place": F.col("__place") + F.col("__read"), "__place": F.col("__place") + F.col("__read")})), keep_state=True)
    out = I.rounded(found.withColumn("fixed_close", F.col("close")))
    out = out.select(*FACT_COLUMNS, *stored, F.lit(version).alias("version"), F.year("date").alias("year"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "year").parquet(f"{table}/rows")
    counts = own.where(F.year("date") >= F.year("since")).groupBy("ticker", "since", F.year("date").alias("year")).agg(F.count("*").alias("n"))
    counts.select(F.lit(version).alias("version"), "ticker", "since", "year", "n").write.mode("append").parquet(f"{table}/log")
    for used in (both, since):
        used.unpersist()


def upsert_landed(spark: SparkSession, landed: str, schema: StructType, table: str, checkpoint: str, rows: int = chunks.ROWS) -> None:
    """Merges files that landed since the last run, later versions of a bar replacing earlier ones; landed rows: RAW_BARS with source_rank and seq."""

    def take(batch: DataFrame, number: int) -> None:
        merge(batch.sparkSession, upsert(batch.select(*schema.fieldNames())), table, 2 * number, rows)  # odd versions are those of compact()

    stream = spark.readStream.schema(schema).parquet(landed)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def compact(spark: SparkSession, table: str) -> None:
    """Writes all rows that hold as one version and takes the versions below away; nobody may be reading them meanwhile."""
    log = _log(spark, table)
    newest = None if log is None else log.agg(F.max("version")).first()[0]
    if newest is None or newest % 2:
        return
    rows = _rows(spark, table, log).drop("version").withColumn("version", F.lit(newest + 1))
    rows.repartitionByRange("year", "ticker", "date").sortWithinPartitions("year", "ticker", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "year").parquet(f"{table}/rows")
    whole = spark.read.option("basePath", f"{table}/rows").parquet(f"{table}/rows").where(F.col("version") == newest + 1)
    first = whole.groupBy("ticker").agg(F.min("date").alias("since"))
    counts = whole.groupBy("ticker", "year").agg(F.count("*").alias("n")).join(first, "ticker")
    counts.select(F.lit(newest + 1).alias("version"), "ticker", "since", "year", "n").write.mode("append").parquet(f"{table}/log")
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    for (v,) in log.select("version").distinct().collect():  # a row a merge since the last time
        files.delete(path(f"{table}/rows/version={v}"), True)
