"""Comparison of two wide tables of measures: unpivoted, joined once, judged cell by cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RTOL, ATOL = 1e-9, 1e-9


def clean_headers(df: DataFrame) -> DataFrame:
    """Header names without a byte order mark and outer blanks."""
    return df.toDF(*(c.replace("﻿", "").strip() for c in df.columns))


def melted(df: DataFrame, key: str) -> DataFrame:
    """(key, measure, value) with values as text."""
    values = [c for c in df.columns if c != key]
    return df.select(key, *(F.col(c).cast("string").alias(c) for c in values)).unpivot(key, values, "measure", "value")


def numeric_measures(before: DataFrame, key: str) -> DataFrame:
    """(measure, numeric): whether at least half of the values before, and one at least, are numbers."""
    return melted(before, key).groupBy("measure").agg((F.count(F.col("value").try_cast("double")) >= F.greatest(F.lit(1), F.floor(0.5 * F.count("*")))).alias("numeric"))


def _number_note(a: Column, b: Column) -> Column:
    gone, new = a.isNotNull() & b.isNull(), a.isNull() & b.isNotNull()
    far = F.abs(a - b) > RTOL * F.greatest(F.abs(a), F.lit(1.0)) + ATOL
    return F.when(gone, "went blank").when(new, "appeared").when(far, "changed")


def changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, measure, before, after, note) of changed cells of common rows and columns; a text that went blank counts as changed."""
    kinds = numeric_measures(before, key)
    a = melted(before, key).withColumnRenamed("value", "before")
    b = melted(after, key).withColumnRenamed("value", "after")
    both = a.join(b, [key, "measure"]).join(F.broadcast(kinds), "measure")  # a row a column of the table
    text = F.when(~F.col("before").eqNullSafe(F.col("after")), "changed")
    note = F.when(F.col("numeric"), _number_note(F.col("before").try_cast("double"), F.col("after").try_cast("double"))).otherwise(text)
    return both.withColumn("note", note).where("note is not null").select(key, "measure", "before", "after", "note")


def full_comparison(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, measure, before, after) of every cell of either table."""
    a = melted(before, key).withColumnRenamed("value", "before")
    b = melted(after, key).withColumnRenamed("value", "after")
    return a.join(b, [key, "measure"], "full_outer")


def structure(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(kind, name, severity): rows and columns that were lost (failures) or are new (warnings)."""
    spark = before.sparkSession
    lost = before.select(key).join(after.select(key), key, "left_anti").select(F.lit("row").alias("kind"), F.col(key).cast("string").alias("name"), F.lit("failure").alias("severity"))
    new = after.select(key).join(before.select(key), key, "left_anti").select(F.lit("row").alias("kind"), F.col(key).cast("string").alias("name"), F.lit("warning").alias("severity"))
    columns = [("column", c, "failure") for c in before.columns if c not in after.columns] + [("column", c, "warning") for c in after.columns if c not in before.columns]
    return lost.unionByName(new).unionByName(spark.createDataFrame(columns, "kind string, name string, severity string"))
