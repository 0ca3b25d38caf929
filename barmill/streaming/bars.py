"""Bars as streams: final sessions by watermark, failure counters as keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from barmill.sources.bars import event_bars


def final_sessions(events: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Daily bars of a stream of (ts, event_id, event_type, value) that come out once the watermark has passed their day."""
    return event_bars(events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay))


class FailureCounter(StatefulProcessor):
    """Bad runs in a row of a ticker; a good run clears the count, runs that don't try the ticker leave it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._count = handle.getValueState("count", StructType([StructField("n", IntegerType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        n = self._count.get()[0] if self._count.exists() else 0
        for r in pd.concat(list(rows)).sort_values("run_id").itertuples():
            n = n + 1 if r.status in ("failed", "no_data") else 0
        if n:
            self._count.update((n,))
        else:
            self._count.clear()
        yield pd.DataFrame({"ticker": [key[0]], "in_a_row": [n], "persistent": [n >= 3]})

    def close(self) -> None:
        pass


def failure_counters(log: DataFrame) -> DataFrame:
    """(ticker, in_a_row, persistent) after each batch of a stream of (run_id, ticker, status)."""
    return log.groupBy("ticker").transformWithStateInPandas(FailureCounter(), "ticker string, in_a_row int, persistent boolean", "Update", "None")
