"""A table of bars by year into which bars are merged by rewriting only the years that they touch.

A merge writes each touched year anew, as rows of a version of its own, and then names the years in the log. Readers take
every year's newest version in the log, so they see all of a merge or nothing of it, and years that weren't touched are
neither read nor written.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmill.operators.cleaning import upsert


def _versions(spark: SparkSession, path: str) -> dict[int, int]:
    """The newest version of each year, as the log has it."""
    try:
        log = spark.read.schema("year int, version int").parquet(f"{path}/log")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return dict(log.groupBy("year").agg(F.max("version")).collect())  # a row a year


def _read(spark: SparkSession, path: str, versions: dict[int, int]) -> DataFrame:
    rows = spark.read.option("basePath", f"{path}/bars").parquet(f"{path}/bars")
    return rows.where(reduce(or_, ((F.col("year") == y) & (F.col("version") == v) for y, v in sorted(versions.items())), F.lit(False))).drop("year", "version")


def read_years(spark: SparkSession, path: str, first: int | None = None) -> DataFrame | None:
    """Every row that holds, of the years from `first` on; None if nothing was merged yet."""
    versions = _versions(spark, path)
    return _read(spark, path, {y: v for y, v in versions.items() if first is None or y >= first}) if versions else None


def merge_years(spark: SparkSession, landed: DataFrame, path: str) -> list[int]:
    """Merges bars with source_rank and seq into the table and gives the years that were written.

    Of rows of one key that with the highest source_rank and seq stays; a landed row replaces a stored one. Rows without a
    date are left out. A merge that fails leaves the table as it was and may be run again.
    """
    landed = landed.where("date is not null")
    years = sorted(y for (y,) in landed.select(F.year("date")).distinct().collect())  # bounded by the calendar
    if not years:
        return []
    versions = _versions(spark, path)
    version = max(versions.values(), default=-1) + 1
    touched = {y: versions[y] for y in years if y in versions}
    both = landed
    if touched:
        both = _read(spark, path, touched).withColumns({"source_rank": F.lit(-1), "seq": F.lit(0)}).unionByName(landed)
    rows = upsert(both).withColumns({"version": F.lit(version), "year": F.year("date")})
    rows = rows.repartitionByRange("year", "ticker", "date").sortWithinPartitions("year", "ticker", "date")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version", "year").parquet(f"{path}/bars")
    spark.createDataFrame([(y, version) for y in years], "year int, version int").coalesce(1).write.mode("append").parquet(f"{path}/log")
    return years
