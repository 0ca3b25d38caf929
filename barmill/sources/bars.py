"""Bars and their companions: schemas, readers, writers, and bars derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BENCHMARK = "INDEX"
BENCHMARK_START = "1997-01-01"

RAW_BARS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("ticker", T.StringType()),
    ]
)
#: The same with every column as text: dates that don't parse are found later, not lost.
LANDED_BARS = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_BARS])
DIM_STOCK = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("vendor_ticker", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("weight", T.DoubleType()),
    ]
)
PRICES = ["open", "high", "low", "close"]
INDICATORS = ["daily_return_pct", "ma20", "ma50", "ma200", "rsi_14", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_lower", "bb_width"]
FACT_COLUMNS = ["date", *PRICES, "volume", "ticker", *INDICATORS, "price_repaired"]


#: File headers that are broadcast at most; with more of them lines are joined with the header of their file.
MOST_HEADERS = 100_000


def read_bar_files(spark: SparkSession, path: str) -> DataFrame:
    """Every CSV bar file of a folder as one long table of text columns, each file by the names in its own header.

    Columns of LANDED_BARS, and `missing`: those that the row's file lacks. The first column of a file is its date. A
    file without a ticker column is that of the ticker it is named after. Cells may be quoted, with commas and doubled
    quotes in them, but no line ends.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    heads = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("head"))  # a row a file
    n, widest = heads.agg(F.count("*"), F.max(F.size(F.split("head", ",")))).first()
    row = ", ".join(f"c{k} string" for k in range(widest or 1))
    cells = lambda line: F.array(*(F.from_csv(line, row, {"escape": '"'})[f"c{k}"] for k in range(widest or 1)))
    names = F.transform(cells(F.col("head")), lambda c, k: F.when(k == 0, "date").otherwise(F.lower(F.trim(c))))
    heads = heads.select("file", "head", names.alias("names"), F.array_except(F.array(*(F.lit(f.name) for f in RAW_BARS)), names).alias("lacks"))
    cell = lambda c: F.nullif(F.get(cells(F.col("value")), F.array_position("names", c).cast("int") - 1), F.lit(""))
    own = F.regexp_extract("file", r"([^/]+?)(?:\.[A-Za-z0-9]+)*$", 1)
    ticker = F.coalesce(cell("ticker"), own)
    missing = F.array_remove("lacks", "ticker").alias("missing")
    found = lines.join(F.broadcast(heads) if n <= MOST_HEADERS else heads, "file").where("value <> head and value <> ''")
    return found.select(*((ticker if f.name == "ticker" else cell(f.name)).alias(f.name) for f in RAW_BARS), missing)


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DIM_STOCK).csv(path, header=True)


def normalise(landed: DataFrame, ticker: Column | None = None) -> DataFrame:
    """Landed rows in the shape of RAW_BARS; the first column is taken as the date, NaN becomes null, a missing column is an error."""
    own = landed if "date" in landed.columns else landed.withColumnRenamed(landed.columns[0], "date")
    if ticker is not None:
        own = own.withColumn("ticker", ticker)
    missing = [f.name for f in RAW_BARS if f.name not in own.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    number = lambda c: F.nullif(F.col(c).try_cast("double"), F.lit(float("nan")))
    date = F.to_date("date") if dict(own.dtypes)["date"] != "string" else F.try_to_date("date", "yyyy-MM-dd")
    return own.select(date.alias("date"), *(number(c).alias(c) for c in PRICES), F.col("volume").try_cast("double").cast("long").alias("volume"), "ticker")


def quarantine(landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine(ticker, reason)): a ticker with a date that doesn't parse, or whose file lacks columns, is left out as a whole, with the reason."""
    lacks = F.max(F.array_join("missing", ", ")) if "missing" in landed.columns else F.lit("")
    each = landed.groupBy("ticker").agg(F.bool_or(F.try_to_date("date", "yyyy-MM-dd").isNull()).alias("bad"), lacks.alias("lacks"))
    reason = F.when(F.col("lacks") != "", F.concat(F.lit("missing columns: "), "lacks")).when(F.col("bad"), "dates do not parse")
    bad = each.select("ticker", reason.alias("reason")).where("reason is not null")
    return landed.join(bad, "ticker", "left_anti").drop("missing"), bad


def since(stored: DataFrame, days: int = 500) -> DataFrame:
    return stored.groupBy("ticker").agg(F.date_sub(F.max("date"), days).alias("since"))


def fresh_since(bars: DataFrame, stored: DataFrame, days: int = 500, first: str = "2000-01-01") -> DataFrame:
    """Bars from `days` before each ticker's last stored date on; all since `first` for a ticker that has none."""
    return bars.join(since(stored, days), "ticker", "left").where(F.col("date") >= F.coalesce("since", F.lit(first).cast("date"))).drop("since")


def read_fresh(spark: SparkSession, path: str, stored: DataFrame, tickers: DataFrame, days: int = 500, first: str = "2000-01-01") -> DataFrame:
    """fresh_since() of the expected tickers, of bars that write_bars() wrote: years before the least date needed aren't read.

    tickers (ticker): those that are expected; others, and rows without a ticker, are left out.
    """
    need = tickers.select("ticker").distinct().join(since(stored, days), "ticker", "left").select("ticker", F.coalesce("since", F.lit(first).cast("date")).alias("since"))
    least = need.agg(F.min("since")).first()[0]
    bars = spark.read.parquet(path)
    if least is None:
        return bars.where("false").drop("year")
    return bars.where((F.col("year") >= least.year) & (F.col("date") >= F.lit(least))).join(need, "ticker").where(F.col("date") >= F.col("since")).drop("since", "year")


def write_bars(bars: DataFrame, path: str) -> None:
    """Replaces the years that are written and leaves the others; a year is dealt to as many tasks as its share of the rows takes."""
    bars.withColumn("year", F.year("date")).repartitionByRange("year", "ticker", "date").sortWithinPartitions("year", "ticker", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path)


def write_fact(fact: DataFrame, path: str) -> None:
    """The fact table in (ticker, date) order over all files, without gathering it in one."""
    fact.repartitionByRange("ticker", "date").sortWithinPartitions("ticker", "date").write.mode("overwrite").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").parquet(path)


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def derived_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each nation's suppliers, and of all trades as the benchmark."""
    lines, suppliers, nations = tables(spark, sf_dir, "lineitem", "supplier", "nation")
    trade = [F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("k")]
    trades = lines.select("l_suppkey", F.col("l_shipdate").cast("date").alias("date"), (F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100).alias("price"), "l_quantity", *trade)
    names = suppliers.join(F.broadcast(nations), suppliers.s_nationkey == nations.n_nationkey).select("s_suppkey", F.col("n_name").alias("ticker"))  # 25 nations
    own = trades.join(names, trades.l_suppkey == names.s_suppkey).select("ticker", "date", "price", "l_quantity", "k")
    whole = trades.where(F.col("date") >= F.lit(BENCHMARK_START).cast("date")).select(F.lit(BENCHMARK).alias("ticker"), "date", "price", "l_quantity", "k")
    return own.unionByName(whole).groupBy("ticker", "date").agg(
        F.min_by("price", "k").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "k").alias("close"), F.sum("l_quantity").cast("long").alias("volume")
    )


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stock for each nation, and one that never traded."""
    nations, regions = tables(spark, sf_dir, "nation", "region")
    own = nations.join(F.broadcast(regions), nations.n_regionkey == regions.r_regionkey)
    own = own.select(F.col("n_name").alias("ticker"), F.concat("n_name", F.lit(".X")).alias("vendor_ticker"), F.concat(F.lit("Company "), "n_name").alias("company"), F.col("r_name").alias("sector"), (F.col("n_nationkey") / 10.0).alias("weight"))
    return own.unionByName(spark.sql("SELECT 'UNLISTED' AS ticker, 'UNLISTED.X' AS vendor_ticker, 'Company UNLISTED' AS company, 'ASIA' AS sector, 0D AS weight"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, ticker, status, repaired): a user's last event of a day decides whether the run of that day failed; one of a value above 40 is a repair."""
    events = tables(spark, sf_dir, "events")[0]
    day = F.datediff(F.col("ts").cast("date"), F.lit("2020-01-01").cast("date"))
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    return events.groupBy(day.cast("long").alias("run_id"), F.col("user_id").cast("string").alias("ticker")).agg(F.when(last == "error", "failed").otherwise("ok").alias("status"), F.count_if(F.col("value") > 40).alias("repaired"))


def event_bars(events: DataFrame, width: str = "1 day") -> DataFrame:
    """Tumbling bars of events by type; works on streams too."""
    return events.groupBy(F.window("ts", width), "event_type").agg(
        F.min_by("value", F.struct("ts", "event_id")).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.count("*").alias("volume")
    ).select(F.col("window.start").cast("date").alias("date"), F.col("event_type").alias("ticker"), "open", "high", "low", "close", "volume")


def dirty_bars(bars: DataFrame) -> DataFrame:
    """Bars with faults by rule on the date, and second versions: (…, source_rank, seq)."""
    day = F.dayofmonth("date")
    first = bars.withColumns({"source_rank": F.lit(0), "seq": F.lit(0)})
    second = bars.where(day == 21).withColumns({"close": F.col("close") + 1, "source_rank": F.lit(1), "seq": F.lit(1)})
    out = first.unionByName(second)
    return out.withColumns({"close": F.when(day == 13, None).otherwise(F.col("close")), "low": F.when(day == 17, -F.col("low")).otherwise(F.col("low"))})
