"""Indicators that are weighted means: steps of the blocked pass over the series."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import col, ieee_div
from tidewater.operators.arrays import Held
from tidewater.operators.blocks import Step, run_steps


def ewm(df: DataFrame, steps: list[Step], key: str = "ticker", time: str = "date", **options) -> DataFrame:
    """Append a column for each step (see ``blocks``), in order; a step may read an earlier one's output."""
    return run_steps(df, steps, key, time, **options)


def ema(df: DataFrame, source: str = "close", spans=(10, 20)) -> DataFrame:
    return ewm(df, [(source, 2 / (s + 1), s, f"ema{s}") for s in spans])


def before(source: str, rows: int = 1) -> Step:
    """The value ``rows`` rows ago, as ``__source_rows``."""
    return (source, "lag", rows, f"__{source}_{rows}")


def of_row(value: Column, out: str, *names: str, array: Callable | None = None) -> Step:
    """A column of the row's own values, of the columns ``names``; ``array`` is its form over ``Held`` ones."""
    return (names, value, None, out, *([array] if array else []))


def _less(a: Held, b: Held) -> np.ndarray:
    return a.x - b.x


def _true_range(h: Held, low: Held, last: Held) -> np.ndarray:
    """As ``greatest``, which passes nulls over and takes NaN for the largest."""
    parts = [(h.x - low.x, h.null | low.null), (np.abs(h.x - last.x), h.null), (np.abs(low.x - last.x), low.null)]
    most = np.maximum.reduce([np.where(null, -np.inf, x) for x, null in parts])
    return np.where(last.null | (h.null & low.null), np.nan, most)


def _gain(close: Held, last: Held) -> np.ndarray:
    up = close.x - last.x
    return np.where(close.null | last.null | (up <= 0), 0.0, up)


def _loss(close: Held, last: Held) -> np.ndarray:
    return _gain(last, close)


def true_range_steps() -> list[Step]:
    h, low, last = col("high"), col("low"), F.col("__close_1")
    span = F.when(last.isNotNull(), F.greatest(h - low, F.abs(h - last), F.abs(low - last)))
    return [before("close"), of_row(span, "__tr", "high", "low", "__close_1", array=_true_range)]


def atr_step(period: int) -> Step:
    return ("__tr", 1 / period, period, f"atr{period}")


def atr(df: DataFrame, period: int = 20) -> DataFrame:
    return _done(df, [*true_range_steps(), atr_step(period)])


def rsi_steps(period: int) -> list[Step]:
    """Means of gains and losses; the first row of a ticker has zeros, which count."""
    d = col("close") - F.col("__close_1")
    up, down = (of_row(F.when(x > 0, x).otherwise(F.lit(0.0)), n, "close", "__close_1", array=f) for x, n, f in ((d, "__up", _gain), (-d, "__down", _loss)))
    return [before("close"), up, down, ("__up", 1 / period, period, "__gain"), ("__down", 1 / period, period, "__loss"), of_row(rsi_value(), f"rsi{period}", "__gain", "__loss")]


def rsi_value() -> Column:
    return 100 - ieee_div(F.lit(100.0), 1 + ieee_div(F.col("__gain"), F.col("__loss")))


def rsi(df: DataFrame, period: int = 14) -> DataFrame:
    return _done(df, rsi_steps(period))


def macd_steps(fast: int = 12, slow: int = 26, signal: int = 9) -> list[Step]:
    lines = [("close", 2 / (n + 1), n, out) for n, out in ((fast, "__fast"), (slow, "__slow"))]
    return [*lines, of_row(F.col("__fast") - F.col("__slow"), "macd", "__fast", "__slow", array=_less), ("macd", 2 / (signal + 1), signal, "macd_signal")]


def macd(df: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    return _done(df, macd_steps(fast, slow, signal))


def adx(df: DataFrame, period: int = 14) -> DataFrame:
    a = 1 / period
    up, down = col("high") - F.col("__high_1"), F.col("__low_1") - col("low")
    plus, minus = (F.when((x > y) & (x > 0), x).otherwise(F.lit(0.0)) for x, y in ((up, down), (down, up)))
    moved = ("high", "low", "__high_1", "__low_1")
    p, m = F.try_divide(100 * F.col("__ps"), F.col("__atr")), F.try_divide(100 * F.col("__ms"), F.col("__atr"))
    steps = [
        *true_range_steps(), before("high"), before("low"), of_row(plus, "__pdm", *moved), of_row(minus, "__mdm", *moved),
        ("__tr", a, period, "__atr"), ("__pdm", a, period, "__ps"), ("__mdm", a, period, "__ms"),
        of_row(F.try_divide(100 * F.abs(p - m), p + m), "__dx", "__ps", "__ms", "__atr"), ("__dx", a, period, f"adx{period}"),
    ]
    return _done(df, steps)


def _done(df: DataFrame, steps: list[Step]) -> DataFrame:
    """The steps' results without the columns they needed on the way."""
    out = ewm(df, list({s[3]: s for s in steps}.values()))
    return out.drop(*[s[3] for s in steps if s[3].startswith("__")])


def ewma_vol(df: DataFrame, decay: float = 0.94, annualize_factor: float = 252.0) -> DataFrame:
    """Recursive variance of log returns, seeded with the first squared return."""
    square = F.pow(F.ln(F.try_divide(col("close"), F.col("__close_1"))), F.lit(2.0))
    out = ewm(df, [before("close"), of_row(square, "__r2", "close", "__close_1"), ("__r2", 1 - decay, 1, "__v", False)])
    return out.withColumn("ewma_variance", F.col("__v") * annualize_factor).withColumn("ewma_vol", F.sqrt("ewma_variance")).drop("__close_1", "__r2", "__v")


AD_STEP = ("__ad", 2 / 66, 20, "ad")


def ad_score(df: DataFrame) -> DataFrame:
    return ewm(df, [AD_STEP])

