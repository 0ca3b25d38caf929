"""Measures in plain words. The thresholds and the sentences are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _tiers(x: Column, tiers: list[tuple[float, str]], rest: str, missing: str) -> Column:
    out = F.when(x.isNull(), missing)
    for least, text in tiers:
        out = out.when(x > least, text)
    return out.otherwise(rest)


def beta_label(beta: Column) -> Column:
    tier = _tiers(beta, [(1.3, "Very high risk"), (1.0, "High risk"), (0.7, "Moderate risk")], "Low risk", "")
    return F.when(beta.isNull(), "Beta not available").otherwise(F.format_string("%s - moves %.2fx the market", tier, beta))


def sharpe_label(sharpe: Column) -> Column:
    tiers = [(0.50, "Top tier among index stocks"), (0.36, "Above average among index stocks"), (0.30, "Below average among index stocks"), (0.0, "Bottom tier among index stocks")]
    return _tiers(sharpe, tiers, "Underperformed a risk-free deposit", "Risk-adjusted return not available")


def rsi_signal(rsi: Column) -> Column:
    tiers = [(70, "Overbought - buying has been heavy lately"), (55, "Bullish momentum"), (45, "Neutral - no clear momentum"), (30, "Bearish momentum")]
    return _tiers(rsi, tiers, "Oversold - selling has been heavy lately", "Not enough history for RSI")


def ma_signal(price: Column, average: Column, window: int, horizon: str) -> Column:
    missing = F.when(average.isNull(), f"Not enough history for a {window}-day average")
    return missing.when(price > average, f"Above its {window}-day average - {horizon} uptrend").otherwise(f"Below its {window}-day average - {horizon} downtrend")


def overall_signal(price: Column, ma50: Column, ma200: Column, rsi: Column) -> Column:
    bullish = (rsi > 50).cast("int") + (price > ma50).cast("int") + (price > ma200).cast("int")
    texts = ["None of the three trend indicators are positive", "One of three trend indicators is positive", "Two of three trend indicators are positive", "All three trend indicators are positive"]
    return F.when(bullish.isNull(), "Not enough history for a full signal").otherwise(F.element_at(F.array(*map(F.lit, texts)), bullish + 1))


def outperform_label(alpha: Column) -> Column:
    missing = F.when(alpha.isNull(), "Not enough history to compare")
    return missing.when(alpha >= 0, F.format_string("Beat the index by %.2f%%", F.abs(alpha))).otherwise(F.format_string("Lagged the index by %.2f%%", F.abs(alpha)))


def ten_year_display(value: Column, first: Column) -> Column:
    return F.when(value.isNull(), F.concat(F.lit("No 10Y history - listed "), F.date_format(first, "MMM yyyy"))).otherwise(F.format_string("%.2f%%", value))


def data_as_of(date: Column) -> Column:
    return F.concat(F.lit("Data as of "), F.date_format(date, "dd MMM yyyy"))
