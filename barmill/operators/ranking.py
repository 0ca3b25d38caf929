"""Places in an order over a whole table, without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmill.sources.shared import shared_dir


def numbered(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """rows with their place (from 0) in the order; rows that tie are in any order among themselves.

    The rows are dealt to tasks by ranges of the order and written to the shared folder as sorted runs; a run's places
    start behind the rows of the runs before it, of which there are as many as tasks.
    """
    path = shared_dir(rows.sparkSession, "runs")
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the place within the task
    sorted_.withColumns({"__run": F.spark_partition_id(), "__at": at}).write.parquet(path)
    own = rows.sparkSession.read.parquet(path)
    sizes = own.groupBy("__run").agg(F.count("*").alias("__n")).collect()  # a row a task
    starts, before = [], 0
    for run, n in sorted(sizes):
        starts.append((run, before))
        before += n
    offsets = rows.sparkSession.createDataFrame(starts, "__run int, __before long")
    return own.join(F.broadcast(offsets), "__run").withColumn(name, F.col("__before") + F.col("__at")).drop("__run", "__at", "__before")


def percent_ranks(rows: DataFrame, column: str, name: str = "percent_rank") -> DataFrame:
    """rows with the share of the other rows that lie below them by the column, nulls lowest; equal values share a rank."""
    placed = numbered(rows, [F.col(column).asc_nulls_first()], "__place")
    path = shared_dir(rows.sparkSession, "ranks")
    placed.groupBy(F.col(column).alias("__value")).agg(F.min("__place").alias("__rank")).write.parquet(path)  # so that a hot value can be split in the join
    first = rows.sparkSession.read.parquet(path)
    total = placed.agg(F.count("*").alias("__total"))  # one row
    own = placed.join(first, placed[column].eqNullSafe(F.col("__value"))).crossJoin(F.broadcast(total))
    share = F.when(F.col("__total") > 1, F.col("__rank") / (F.col("__total") - 1)).otherwise(F.lit(0.0))
    return own.withColumn(name, share).drop("__place", "__rank", "__value", "__total")

