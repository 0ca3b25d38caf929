"""DuckDB fragments for the oracles: the derived bars and everything that is computed from them."""

from __future__ import annotations


def sig6(x: str) -> str:
    scale = f"pow(10.0, 5 - floor(log10(abs({x}))))"
    finer = f"pow(10.0, 11 - floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN {x} ELSE round(round({x} * {finer}) / {finer} * {scale}) / {scale} END"


BARS = """
trades AS (
  SELECT n_name AS ticker, cast(l_shipdate AS DATE) AS date, floor(l_extendedprice / l_quantity * 100 + 0.5::DOUBLE) / 100 AS price, l_quantity AS q,
    row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey),
dealt AS (
  SELECT * FROM trades WHERE ticker IS NOT NULL
  UNION ALL SELECT 'INDEX', date, price, q, k FROM trades WHERE date >= DATE '1997-01-01'),
bars AS (
  SELECT ticker, date, arg_min(price, k) AS open, max(price) AS high, min(price) AS low, arg_max(price, k) AS close, cast(sum(q) AS BIGINT) AS volume
  FROM dealt GROUP BY ticker, date)"""

DIM = """
dim AS (
  SELECT n_name AS ticker, n_name || '.X' AS vendor_ticker, 'Company ' || n_name AS company, r_name AS sector, n_nationkey / 10.0::DOUBLE AS weight
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'UNLISTED', 'UNLISTED.X', 'Company UNLISTED', 'ASIA', 0.0::DOUBLE)"""

_F = "((p + n) / 2 / close)"
FIXED = (
    BARS
    + """,
lagged AS (SELECT *, lag(close) OVER t AS p, lead(close) OVER t AS n FROM bars WINDOW t AS (PARTITION BY ticker ORDER BY date)),
flagged AS (SELECT *, coalesce(abs(close / p - 1) > 0.4 AND abs(close / n - 1) > 0.4 AND abs(n / p - 1) < 0.2, false) AS bad FROM lagged),
fixed AS (
  SELECT ticker, date, volume, bad AS price_repaired, """
    + ", ".join(f"CASE WHEN bad THEN {sig6(f'({c} * {_F})')} ELSE {c} END AS {c}" for c in ("open", "high", "low", "close"))
    + " FROM flagged)"
)


def _frame(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


ROLLED = (
    FIXED
    + ",\nrolled AS (SELECT *, (close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1) * 100 AS ret, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn"
    + "".join(f", CASE WHEN count(close) OVER {_frame(n)} = {n} THEN avg(close) OVER {_frame(n)} END AS ma{n}" for n in (20, 50, 200))
    + f", CASE WHEN count(close) OVER {_frame(20)} = 20 THEN stddev_samp(close) OVER {_frame(20)} END AS s20 FROM fixed)"
)

RECURSIVE = (
    ROLLED
    + """,
num AS (SELECT ticker, date, close, rn, close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS ch FROM rolled),
seed AS (SELECT ticker, avg(greatest(ch, 0)) AS g, avg(greatest(-ch, 0)) AS l FROM num WHERE rn BETWEEN 2 AND 15 GROUP BY ticker HAVING count(*) = 14),
wilder AS (
  SELECT ticker, 15::BIGINT AS rn, g, l FROM seed
  UNION ALL
  SELECT m.ticker, m.rn, (w.g * 13 + greatest(m.ch, 0)) / 14, (w.l * 13 + greatest(-m.ch, 0)) / 14 FROM wilder w JOIN num m ON m.ticker = w.ticker AND m.rn = w.rn + 1),
ema AS (
  SELECT ticker, rn, close AS f, close AS s, 0::DOUBLE AS g FROM num WHERE rn = 1
  UNION ALL
  SELECT m.ticker, m.rn, m.close * (2::DOUBLE / 13) + e.f * (11::DOUBLE / 13), m.close * (2::DOUBLE / 27) + e.s * (25::DOUBLE / 27),
    (m.close * (2::DOUBLE / 13) + e.f * (11::DOUBLE / 13) - m.close * (2::DOUBLE / 27) - e.s * (25::DOUBLE / 27)) * 0.2::DOUBLE + e.g * 0.8::DOUBLE
  FROM ema e JOIN num m ON m.ticker = e.ticker AND m.rn = e.rn + 1),
full_ AS (
  SELECT r.*, CASE WHEN w.l = 0 THEN 100 ELSE 100 - 100 / (1 + w.g / w.l) END AS rsi, e.f - e.s AS macd, e.g AS macd_signal, e.f - e.s - e.g AS macd_hist
  FROM rolled r LEFT JOIN wilder w USING (ticker, rn) LEFT JOIN ema e USING (ticker, rn))"""
)

STORED = (
    RECURSIVE
    + ",\nbanded AS (SELECT *, ma20 + 2 * s20 AS bb_upper, ma20 - 2 * s20 AS bb_lower FROM full_)"
    + ",\nstored AS (SELECT ticker, date, volume, price_repaired, "
    + ", ".join(f"{sig6(c)} AS {c}" for c in ("open", "high", "low", "close", "ma20", "ma50", "ma200", "macd", "macd_signal", "macd_hist", "bb_upper", "bb_lower"))
    + ", round(ret, 4) AS ret, round(rsi, 4) AS rsi_14, round(4 * s20 / ma20 * 100, 4) AS bb_width, ma20 AS ma20_, ma50 AS ma50_, ma200 AS ma200_, s20 FROM banded)"
)
#: All columns of the fact.
FACT = "SELECT ticker, date, open, high, low, close, volume, price_repaired, ret AS daily_return_pct, ma20, ma50, ma200, rsi_14, macd, macd_signal, macd_hist, bb_upper, bb_lower, bb_width FROM stored"

MARKET = (
    STORED
    + """,
bench AS (SELECT date, ret AS m FROM stored WHERE ticker = 'INDEX'),
start_ AS (SELECT min(date) AS d FROM bench),
joined AS (
  SELECT s.*, b.m, coalesce(s.date >= (SELECT d FROM start_), true) AS in_window, max(s.date) OVER (PARTITION BY ticker) AS latest,
    CASE WHEN ret IS NOT NULL AND m IS NOT NULL THEN ret END AS ps, CASE WHEN ret IS NOT NULL AND m IS NOT NULL THEN m END AS pm
  FROM stored s LEFT JOIN bench b USING (date) WHERE s.ticker <> 'INDEX'),
inside AS (SELECT *, CASE WHEN in_window THEN ret END AS wr, CASE WHEN in_window THEN close END AS wc FROM joined),
peaked AS (
  SELECT *, CASE WHEN in_window THEN (close - max(wc) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING)) / max(wc) OVER (PARTITION BY ticker ORDER BY date ROWS UNBOUNDED PRECEDING) * 100 END AS dd
  FROM inside)"""
)


def _trailing(n: int, at: str = "latest") -> str:
    base = f"arg_max(close, date) FILTER (WHERE date <= cast({at} - INTERVAL {12 * n} MONTH AS DATE))"
    return f"(arg_max(close, date) - {base}) / {base} * 100"


def _unsigned(x: str) -> str:
    """A zero without a sign."""
    return f"CASE WHEN {x} = 0 THEN 0 ELSE {x} END"


_EXCESS = "(wr - 0.065::DOUBLE / 252 * 100)"
BY_METRIC = {
    "beta": "CASE WHEN count(ps) >= 60 AND var_samp(pm) <> 0 THEN " + _unsigned("round(covar_samp(ps, pm) / var_samp(pm), 3)") + " END",
    "slope": "CASE WHEN count(ps) >= 60 THEN round(regr_slope(ps, pm), 6) END",
    "correlation": "CASE WHEN count(ps) >= 60 THEN " + _unsigned("round(corr(ps, pm), 3)") + " END",
    "sharpe_ratio": f"CASE WHEN count(wr) >= 60 AND stddev_samp(wr) <> 0 THEN round(avg({_EXCESS}) / stddev_samp({_EXCESS}) * sqrt(252), 3) END",
    "annual_volatility_pct": "CASE WHEN count(wr) >= 60 THEN round(stddev_samp(wr) * sqrt(252), 2) END",
    "max_drawdown_pct": "round(min(dd), 2)",
    **{f"return_{n}y_pct": f"round({_trailing(n)}, 2)" for n in (1, 3, 5)},
    "latest_rsi": "arg_max(rsi_14, date) FILTER (WHERE rsi_14 IS NOT NULL)",
    "latest_close": "arg_max(close, date)",
    "last_date": "max(date)",
    "data_points": "count(*)",
    "risk_window_start": "min(date) FILTER (WHERE in_window)",
}
METRICS = (
    MARKET
    + ","
    + DIM
    + ",\nper AS (SELECT ticker, "
    + ", ".join(f"{sql} AS {name}" for name, sql in BY_METRIC.items() if name != "slope")
    + " FROM peaked GROUP BY ticker),\nmetrics AS (SELECT d.ticker, d.company, d.sector, per.* EXCLUDE (ticker) REPLACE (coalesce(data_points, 0) AS data_points) FROM dim d LEFT JOIN per USING (ticker))"
)

PRICES = (
    METRICS
    + """,
back AS (SELECT *, max(date) OVER (PARTITION BY ticker) AS latest, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n_back FROM stored),
prices AS (
  SELECT ticker, max(date) AS latest_date, min(date) AS first_date, arg_max(close, date) AS price, max(close) FILTER (WHERE n_back = 2) AS previous_close,
    max(high) FILTER (WHERE date > latest - 365) AS high_52w, min(low) FILTER (WHERE date > latest - 365) AS low_52w, """
    + ", ".join(f"{_trailing(n)} AS return_{n}y" for n in (1, 3, 5, 10))
    + """, (arg_max(close, date) - arg_max(close, date) FILTER (WHERE date < date_trunc('year', latest))) / arg_max(close, date) FILTER (WHERE date < date_trunc('year', latest)) * 100 AS return_ytd,
    arg_max(coalesce(rsi_14, -1), date) AS rsi_, arg_max(coalesce(ma50, -1), date) AS ma50_, arg_max(coalesce(ma200, -1), date) AS ma200_
  FROM back GROUP BY ticker),
priced AS (
  SELECT * EXCLUDE (rsi_, ma50_, ma200_), nullif(rsi_, -1) AS rsi, nullif(ma50_, -1) AS ma50, nullif(ma200_, -1) AS ma200,
    (price - previous_close) / previous_close * 100 AS daily_change_pct, (price - high_52w) / high_52w * 100 AS from_high_pct, (price - low_52w) / low_52w * 100 AS from_low_pct
  FROM prices)"""
)

MISSING_BETA = "CASE WHEN beta IS NULL THEN 'Beta not available' ELSE (CASE WHEN beta > 1.3 THEN 'Very high risk' WHEN beta > 1.0 THEN 'High risk' WHEN beta > 0.7 THEN 'Moderate risk' ELSE 'Low risk' END) || ' - moves ' || format('{:.2f}', round(beta, 2)) || 'x the market' END"
SHARPE = "CASE WHEN sharpe_ratio IS NULL THEN 'Risk-adjusted return not available' WHEN sharpe_ratio > 0.5 THEN 'Top tier among index stocks' WHEN sharpe_ratio > 0.36 THEN 'Above average among index stocks' WHEN sharpe_ratio > 0.3 THEN 'Below average among index stocks' WHEN sharpe_ratio > 0 THEN 'Bottom tier among index stocks' ELSE 'Underperformed a risk-free deposit' END"
RSI = "CASE WHEN rsi IS NULL THEN 'Not enough history for RSI' WHEN rsi > 70 THEN 'Overbought - buying has been heavy lately' WHEN rsi > 55 THEN 'Bullish momentum' WHEN rsi > 45 THEN 'Neutral - no clear momentum' WHEN rsi > 30 THEN 'Bearish momentum' ELSE 'Oversold - selling has been heavy lately' END"
OVERALL = "CASE WHEN rsi IS NULL OR ma50 IS NULL OR ma200 IS NULL THEN 'Not enough history for a full signal' ELSE list_value('None of the three trend indicators are positive', 'One of three trend indicators is positive', 'Two of three trend indicators are positive', 'All three trend indicators are positive')[1 + (rsi > 50)::INT + (price > ma50)::INT + (price > ma200)::INT] END"


def against(n: int, horizon: str) -> str:
    return f"CASE WHEN ma{n} IS NULL THEN 'Not enough history for a {n}-day average' WHEN price > ma{n} THEN 'Above its {n}-day average - {horizon} uptrend' ELSE 'Below its {n}-day average - {horizon} downtrend' END"


BEAT = "CASE WHEN alpha_1y IS NULL THEN 'Not enough history to compare' WHEN alpha_1y >= 0 THEN 'Beat the index by ' || format('{:.2f}', round(abs(alpha_1y), 2)) || '%' ELSE 'Lagged the index by ' || format('{:.2f}', round(abs(alpha_1y), 2)) || '%' END"
TEN_YEARS = "CASE WHEN return_10y IS NULL THEN 'No 10Y history - listed ' || strftime(first_date, '%b %Y') ELSE format('{:.2f}', round(return_10y, 2)) || '%' END"

DIRTY = (
    BARS
    + """,
versions AS (
  SELECT *, 0 AS source_rank, 0 AS seq FROM bars UNION ALL SELECT * REPLACE (close + 1 AS close), 1, 1 FROM bars WHERE day(date) = 21),
dirty AS (
  SELECT * REPLACE (CASE WHEN day(date) = 13 THEN NULL ELSE close END AS close, CASE WHEN day(date) = 17 THEN -low ELSE low END AS low) FROM versions)"""
)

LOG = """
log AS (
  SELECT cast(cast(ts AS DATE) - DATE '2020-01-01' AS BIGINT) AS run_id, cast(user_id AS VARCHAR) AS ticker,
    CASE WHEN arg_max(event_type, row(ts, event_id)) = 'error' THEN 'failed' ELSE 'ok' END AS status, count(*) FILTER (WHERE value > 40) AS repaired
  FROM events GROUP BY 1, 2)"""

SPENT = """
base AS (
  SELECT o_custkey AS customer, round(sum(o_totalprice), 2) AS total, count(*) AS orders, max(o_orderpriority) AS priority FROM orders GROUP BY o_custkey),
before_ AS (SELECT * FROM base WHERE customer % 11 <> 0),
after_ AS (
  SELECT customer, CASE WHEN customer % 5 = 0 THEN total + 1 WHEN customer % 7 = 0 THEN NULL ELSE total END AS total,
    orders, CASE WHEN customer % 9 = 0 THEN NULL WHEN customer % 8 = 0 THEN 'none' ELSE priority END AS priority FROM base WHERE customer % 13 <> 0),
bm AS (
  SELECT customer, unnest(['total', 'orders', 'priority']) AS measure, unnest([cast(total AS VARCHAR), cast(orders AS VARCHAR), priority]) AS before,
    unnest([total, orders, NULL]) AS b FROM before_),
am AS (
  SELECT customer, unnest(['total', 'orders', 'priority']) AS measure, unnest([cast(total AS VARCHAR), cast(orders AS VARCHAR), priority]) AS after,
    unnest([total, orders, NULL]) AS a FROM after_)"""
