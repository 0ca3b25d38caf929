"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared folder (spark.checkpoint.dir).

    Only where that setting is unset and Spark runs in one process, as in tests, a temporary folder is taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local($|\[)", master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: its lineage ends there and a lost executor costs no recomputation."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only (doc_id, text); a null text counts as empty, other columns never matter."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def kept_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text", once: bool = True) -> DataFrame:
    """Rows of docs whose id and text are among kept's (doc_id, text_key); once: of rows that repeat both, one.

    The one is that whose columns have the least hash together, so it doesn't depend on the order of the rows; rows that
    repeat are combined within each task before they are shuffled. Null ids and null texts count as values of their own
    and as empty; an empty table gives an empty one.
    """
    key, row, own_id, own_key = (unused(docs, c) for c in ("__key", "__row", "__id", "__text"))
    own = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    keys = kept.select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key))
    out = own.join(keys, own[id_col].eqNullSafe(keys[own_id]) & (own[key] == keys[own_key]), "left_semi")
    if not once:
        return out.drop(key)
    parts = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields]
    first = F.min_by(F.struct(*docs.columns), F.xxhash64(*parts)).alias(row)
    return out.groupBy(F.col(id_col).alias(own_id), key).agg(first).select(f"{row}.*")


def unused(df: DataFrame, name: str) -> str:
    """name, with further underscores if df has such a column."""
    have = {c.lower() for c in df.columns}
    while name in have:
        name += "_"
    return name


def byte_slices(batch: pa.RecordBatch, column: str = "text", most: int = 16 << 20):
    """Cuts a record batch into runs of rows of at most about `most` bytes of text (one row at least)."""
    import numpy as np

    sizes = np.diff(string_offsets(batch.column(column)))
    if not len(sizes):
        return
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def string_offsets(column: pa.Array):
    """Offsets of a string or binary array as numpy integers."""
    import numpy as np

    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def string_bytes(column: pa.Array):
    """The bytes that the offsets of string_offsets() point into."""
    data = column.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b"")


def binary_array(payload, offsets) -> pa.Array:
    """A large-binary Arrow array over one numpy buffer and its offsets, without a copy for each row."""
    import numpy as np

    offsets = np.ascontiguousarray(offsets, dtype=np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(payload)]).cast(pa.binary())


def ragged(starts, lengths):
    """Positions of all items of the ragged rows (starts, lengths), in order."""
    import numpy as np

    lengths = np.asarray(lengths, dtype=np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths)
