"""Sessions that come out on closing and again, corrected, when a late bar arrives within a stated time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_STATE = "open double, open_ts long, open_id long, high double, low double, close double, close_ts long, close_id long, volume long, version int"
_DAY = 24 * 3_600_000


class Session(StatefulProcessor):
    """The bar of a ticker and day. version counts what came out, from 0 on closing; -1 before.

    The watermark lags the newest event by `late_ms`, so it passes the day's end less that time when the day closes, and
    the day's end when no later row can be accepted: two timers, the second of which removes the state.
    """

    def __init__(self, late_ms: int):
        self._late = late_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._bar = handle.getValueState("bar", _STATE)

    def _out(self, key, bar: tuple) -> pd.DataFrame:
        return pd.DataFrame({"ticker": [key[0]], "date": [key[1]], "version": [bar[9]], "open": [bar[0]], "high": [bar[3]], "low": [bar[4]], "close": [bar[5]], "volume": [bar[8]]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bar = tuple(self._bar.get()) if self._bar.exists() else None
        if bar is None:
            end = int(pd.Timestamp(key[1]).value // 1_000_000) + _DAY
            for at in {end - self._late, end}:
                self._handle.registerTimer(at)
        for own in rows:
            own = own.assign(us=own["ts"].dt.tz_localize(None).astype("datetime64[us]").astype("int64")).sort_values(["us", "event_id"])
            first, last = own.iloc[0], own.iloc[-1]
            new = (float(first["value"]), int(first["us"]), int(first["event_id"]), float(own["value"].max()), float(own["value"].min()), float(last["value"]), int(last["us"]), int(last["event_id"]), len(own), -1)
            if bar is not None:
                start, stop = min((bar[:3], new[:3]), key=lambda x: x[1:]), max((bar[5:8], new[5:8]), key=lambda x: x[1:])
                new = (*start, max(bar[3], new[3]), min(bar[4], new[4]), *stop, bar[8] + new[8], bar[9])
            bar = new
        if bar[9] >= 0:  # it came out before
            bar = (*bar[:9], bar[9] + 1)
            yield self._out(key, bar)
        self._bar.update(bar)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bar = tuple(self._bar.get()) if self._bar.exists() else None
        if bar is not None and bar[9] < 0:
            bar = (*bar[:9], 0)
            self._bar.update(bar)
            yield self._out(key, bar)
        if expiredTimerInfo.getExpiryTimeInMs() >= int(pd.Timestamp(key[1]).value // 1_000_000) + _DAY:
            self._bar.clear()

    def close(self) -> None:
        pass


def corrected_sessions(events: DataFrame, late_hours: int) -> DataFrame:
    """(ticker, date, version, open, high, low, close, volume) of a stream of (ts, event_id, event_type, value).

    Version 0 comes out once an event of a later day was seen, further ones for rows that are at most late_hours older than
    the newest event when they arrive; older rows are dropped, and a session's state goes when none can come any more.
    Rows without a time or a value are left out. Days are those of the session's time zone, which should be UTC.
    """
    own = events.where("ts is not null and value is not null").select(F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("event_type").alias("ticker"), "value")
    own = own.withWatermark("ts", f"{late_hours} hours").withColumn("date", F.to_date("ts"))
    out = "ticker string, date date, version int, open double, high double, low double, close double, volume long"
    return own.groupBy("ticker", "date").transformWithStateInPandas(Session(late_hours * 3_600_000), out, "Append", "EventTime")
