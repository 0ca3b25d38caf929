"""Indicators of a ticker's closes: rolling ones as windows, recursive ones by a helper, all within chunks of a history."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmill.functions.calendar import date_parts
from barmill.functions.numbers import round_significant
from barmill.operators import chunks
from barmill.operators.cleaning import by_date, repaired
from barmill.sources.bars import PRICES

#: Rows of Wilder's averages, and what the newest value weighs in those of the MACD.
PERIOD, FAST, SLOW, SIGNAL = 14, 2 / 13, 2 / 27, 2 / 10


def daily_return(close: str = "close", within: tuple[str, ...] = chunks.WITHIN) -> Column:
    return (F.try_divide(F.col(close), F.lag(close).over(by_date(*within))) - 1) * 100


def _full(n: int, value, within: tuple[str, ...]) -> Column:
    """The aggregate over the last n rows where there are as many closes."""
    w = by_date(*within).rowsBetween(1 - n, 0)
    return F.when(F.count("close").over(w) == n, value("close").over(w))


def moving_average(n: int, within: tuple[str, ...] = chunks.WITHIN) -> Column:
    return _full(n, F.avg, within)


def bollinger(n: int = 20, width: float = 2.0, within: tuple[str, ...] = chunks.WITHIN) -> dict[str, Column]:
    mean, spread = _full(n, F.avg, within), _full(n, F.stddev_samp, within)
    return {"bb_upper": mean + width * spread, "bb_lower": mean - width * spread, "bb_width": F.try_divide(2 * width * spread, mean) * 100}


def _decayed(x: np.ndarray, share: float, start: float | None) -> np.ndarray:
    """Each value weighs `share`, what came before the rest; without a start the first value stands for it."""
    out = pd.Series(x if start is None else np.append(start, x)).ewm(alpha=share, adjust=False).mean().to_numpy()
    return out if start is None else out[1:]


def _wilder(x: np.ndarray, k: np.ndarray, start: float) -> np.ndarray:
    """Averages of changes number k (from 1): up to PERIOD the sum so far over PERIOD, from there on decayed."""
    seed = k <= PERIOD
    head = start + np.cumsum(x[seed]) / PERIOD
    tail = _decayed(x[~seed], 1 / PERIOD, head[-1] if len(head) else start) if not seed.all() else head[:0]
    return np.concatenate([head, tail])


class State(NamedTuple):
    """Averages at the end of some rows of a ticker; None before its first row."""

    fast: float | None
    slow: float | None
    signal: float | None
    gain: float = 0.0
    loss: float = 0.0


def _advance(close: np.ndarray, before: int, previous: float | None, start: State) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """Of closes that follow `before` rows, the last of close `previous`, in this state: indicators, and the state behind every row."""
    fast, slow = (_decayed(close, share, s) for share, s in ((FAST, start.fast), (SLOW, start.slow)))
    macd = fast - slow
    signal = _decayed(macd, SIGNAL, start.signal)
    k = before + np.arange(len(close))
    change = np.diff(close, prepend=close[0] if previous is None else previous)[k > 0]
    gain, loss = np.zeros(len(close)), np.zeros(len(close))  # none behind a ticker's first row
    gain[k > 0], loss[k > 0] = (_wilder(x.clip(min=0), k[k > 0], s) for x, s in ((change, start.gain), (-change, start.loss)))
    rsi = np.full(len(close), np.nan)
    late = k >= PERIOD
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi[late] = np.where(loss == 0, 100.0, 100 - 100 / (1 + gain / loss))[late]
    states = dict(zip(State._fields, (fast, slow, signal, gain, loss)))
    return {"rsi_14": rsi, "macd": macd, "macd_signal": signal, "macd_hist": macd - signal}, states


def _chained(start: State, own: State, n: int, before: int) -> State:
    """The state behind n rows from a state ahead of them, own being theirs from zeros: all averages are linear in it."""
    if start.fast is None:
        return own
    left = lambda share: (1 - share) ** n
    lent = lambda share: SIGNAL * (1 - share) * (left(SIGNAL) - left(share)) / (share - SIGNAL)  # noqa: E731  what a start lends the signal over n rows
    kept = (1 - 1 / PERIOD) ** max(0, min(n, before + n - 1 - PERIOD))
    return State(
        left(FAST) * start.fast + own.fast,
        left(SLOW) * start.slow + own.slow,
        left(SIGNAL) * start.signal + lent(FAST) * start.fast - lent(SLOW) * start.slow + own.signal,
        kept * start.gain + own.gain,
        kept * start.loss + own.loss,
    )


def wilder_rsi(close: np.ndarray) -> np.ndarray:
    """Null for the first PERIOD rows; the averages start as plain means of the first changes, then decay."""
    return _advance(close, 0, None, _NONE)[0]["rsi_14"] if len(close) else np.zeros(0)


#: Names of the columns that hold the state behind each row.
STATE = [f"state_{c}" for c in State._fields]
_NONE = State(None, None, None)


def recursive(rows: DataFrame, keep_state: bool = False) -> DataFrame:
    """Rows that were dealt with a halo of one row at least, halos dropped, with rsi_14, macd, macd_signal and macd_hist.

    One pass takes each chunk's averages from zeros, the few chunks of a ticker are chained, and a second pass starts each
    chunk from its true state; both passes read the same exchange, and no task holds more than a chunk. With a column
    __known, rows where it is true aren't computed: their STATE columns hold the state behind them, from which the rows
    that follow go on. keep_state: the STATE columns are given for every row.
    """
    known = "__known" in rows.columns
    names = [c for c in rows.columns if c not in ("__place", "__chunk", "__core", "__known", *STATE)]

    def begun(own: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, int, float | None, State | None]:
        """(rows sorted, those to compute, rows before them, close before them, state before them if it is known)."""
        own = own.sort_values("__place")
        todo = own["__core"].to_numpy(bool) & ~(own["__known"].to_numpy(bool) if known else np.zeros(len(own), bool))
        if not todo.any():
            return own, own[todo], 0, None, None
        at = int(todo.argmax())
        before = int(own["__place"].iloc[at])
        if not before:
            return own, own[todo], 0, None, _NONE
        last = own.iloc[at - 1]
        state = State(*(float(last[c]) for c in STATE)) if known and last["__known"] else None
        return own, own[todo], before, float(last["close"]), state

    def from_zeros(own: pd.DataFrame) -> pd.DataFrame:
        _, todo, before, previous, state = begun(own)
        if todo.empty:
            return pd.DataFrame(columns=["ticker", "__chunk", "n", "before", "absolute", *State._fields])
        _, states = _advance(todo["close"].to_numpy(float), before, previous, State(0.0, 0.0, 0.0) if state is None else state)
        return pd.DataFrame({"ticker": own["ticker"].iloc[:1].to_numpy(), "__chunk": own["__chunk"].iloc[:1].to_numpy(), "n": len(todo), "before": before, "absolute": state is not None, **{c: [v[-1]] for c, v in states.items()}})

    def starts(own: pd.DataFrame) -> pd.DataFrame:
        state, out = _NONE, []
        for r in own.sort_values("__chunk").to_dict("records"):
            out.append((r["ticker"], r["__chunk"], *state))
            end = State(*(r[c] for c in State._fields))
            state = end if r["absolute"] else _chained(state, end, r["n"], r["before"])
        return pd.DataFrame(out, columns=["ticker", "__chunk", *State._fields])

    def run(own: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        _, todo, before, previous, state = begun(own)
        found = [*("rsi_14", "macd", "macd_signal", "macd_hist"), *(STATE if keep_state else [])]
        if todo.empty:
            return pd.DataFrame(columns=[*names, *found])
        if state is None:
            state = State(*(float(start[c].iloc[0]) for c in State._fields))
        values, states = _advance(todo["close"].to_numpy(float), before, previous, state)
        return todo[names].assign(**values, **(dict(zip(STATE, states.values())) if keep_state else {}))

    chunk = rows.schema["__chunk"].dataType.simpleString()
    floats = lambda names: ", ".join(f"{c} double" for c in names)
    by_chunk = rows.groupBy("ticker", "__chunk")
    own = by_chunk.applyInPandas(from_zeros, f"ticker string, __chunk {chunk}, n long, before long, absolute boolean, {floats(State._fields)}")
    state = own.groupBy("ticker").applyInPandas(starts, f"ticker string, __chunk {chunk}, {floats(State._fields)}")
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    found = floats(["rsi_14", "macd", "macd_signal", "macd_hist", *(STATE if keep_state else [])])
    out = by_chunk.cogroup(state.groupBy("ticker", "__chunk")).applyInPandas(run, f"{kinds}, {found}")
    return out.withColumn("rsi_14", F.nanvl("rsi_14", F.lit(None).cast("double")))


def recursive_indicators(bars: DataFrame, rows: int = chunks.ROWS) -> DataFrame:
    """bars with rsi_14, macd, macd_signal and macd_hist: recurrences over a ticker's whole history, in chunks of so many rows."""
    return recursive(chunks.dealt(bars, 1, 0, rows))


#: Rows before and behind a chunk that its indicators look at: 199 closes, the first of them repaired by its neighbours.
HALO = (200, 1)


def with_recursive(bars: DataFrame, columns: dict[str, Column], rows: int = chunks.ROWS) -> DataFrame:
    """bars with columns that look back at most 199 rows, and the recursive indicators, without repair."""
    return recursive(chunks.dealt(bars, 199, 0, rows).withColumns(columns))


def rolling(rows: DataFrame) -> DataFrame:
    """Rows that were dealt with a halo of 199 rows, with returns, moving averages and bands."""
    return rows.withColumns({"daily_return_pct": daily_return(), **{f"ma{n}": moving_average(n) for n in (20, 50, 200)}, **bollinger()})


def repaired_rolling(bars: DataFrame, rows: int = chunks.ROWS) -> DataFrame:
    """Repair, then returns, moving averages and bands of the repaired closes."""
    return chunks.core(rolling(repaired(chunks.dealt(bars, *HALO, rows))))


def rolling_indicators(bars: DataFrame, rows: int = chunks.ROWS) -> DataFrame:
    return chunks.core(rolling(chunks.dealt(bars, 199, 0, rows)))


def unrounded_indicators(bars: DataFrame, rows: int = chunks.ROWS) -> DataFrame:
    """Repair, then every indicator of the repaired closes; all windows lie within chunks and share one exchange."""
    return recursive(rolling(repaired(chunks.dealt(bars, *HALO, rows))))


def rounded(out: DataFrame) -> DataFrame:
    """All derived columns, rounded last: price-like ones to six significant figures, others to four decimals."""
    price_like = {c: round_significant(F.col(c)) for c in (*PRICES, "ma20", "ma50", "ma200", "bb_upper", "bb_lower", "macd", "macd_signal", "macd_hist")}
    return out.withColumns(date_parts()).withColumns({**price_like, **{c: F.round(c, 4) for c in ("daily_return_pct", "rsi_14", "bb_width")}})


def add_indicators(bars: DataFrame, rows: int = chunks.ROWS) -> DataFrame:
    """Repaired bars with all derived columns."""
    return rounded(unrounded_indicators(bars, rows))


def drawdown(bars: DataFrame, close: str = "close", name: str = "drawdown") -> DataFrame:
    """bars with the per cent below the highest close so far: the running maximum of a month, and that of the months before."""
    own = bars.withColumn("__month", chunks.month())
    peaks = chunks.carried(own.groupBy("ticker", "__month").agg(F.max(close).alias("__most")), F.max("__most"), "__peak").drop("__most")
    inside = F.max(close).over(by_date("ticker", "__month").rowsBetween(Window.unboundedPreceding, 0))
    peak = F.greatest("__inside", "__peak")
    rows = own.withColumn("__inside", inside).join(peaks, ["ticker", "__month"])
    return rows.withColumn(name, F.try_divide(F.col(close) - peak, peak) * 100).drop("__month", "__inside", "__peak")


def _worst(lists: Column) -> Column:
    """(peak, low, worst) of an ordered array of such parts: highest and lowest close, and the deepest fall from the highest so far.

    It merges: a later part's rows fall from the earlier peak to their lowest, or from their own peak as they did already.
    """
    fall = lambda low, peak: F.try_divide(low - peak, peak) * 100
    merge = lambda a, b: F.struct(F.greatest(a["peak"], b["peak"]).alias("peak"), F.least(a["low"], b["low"]).alias("low"), F.least(a["worst"], b["worst"], fall(b["low"], a["peak"])).alias("worst"))
    none = F.lit(None).cast("double")
    return F.aggregate(lists, F.struct(none.alias("peak"), none.alias("low"), none.alias("worst")), merge)


def max_drawdown(bars: DataFrame, close: str = "close") -> DataFrame:
    """(ticker, max_drawdown_pct) by merging months into histories, without a window; null closes are passed over."""
    x = F.col(close).cast("double")
    one = F.when(x.isNotNull(), F.struct("date", x.alias("peak"), x.alias("low"), F.lit(0.0).alias("worst")))
    months = bars.groupBy("ticker", chunks.month().alias("__month")).agg(_worst(F.array_sort(F.collect_list(one))).alias("part"))
    return months.groupBy("ticker").agg(_worst(F.array_sort(F.collect_list(F.struct("__month", "part.*")))).alias("all")).select("ticker", F.col("all.worst").alias("max_drawdown_pct"))
