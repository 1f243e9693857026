"""Price indicators: short frames and lags as windows of one (ticker, date) order, long frames as steps of the blocked pass."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import col, round32, safe_div
from tidewater.operators.arrays import Held
from tidewater.operators.blocks import Step
from tidewater.operators.ewm import ewm
from tidewater.operators.panel import full, lag

SMA_PERIODS = (10, 20, 50, 100, 150, 200)
EXTREME_WINDOWS = (20, 55, 252)
CHANGE_PERIODS = (1, 5, 21, 63, 126, 189, 252)
RS_PERIODS = (63, 126, 189, 252)


def adjust_prices(df: DataFrame) -> DataFrame:
    """Split and dividend adjustment: open, high and low times closeadj/close, close from closeadj."""
    factor = F.try_divide(col("closeadj"), col("close"))
    return df.select("ticker", F.to_date("date").alias("date"), *[(col(c) * factor).alias(c) for c in ("open", "high", "low")], col("closeadj").alias("close"), col("volume").alias("volume"))


def sma_steps(source: str = "close", periods=SMA_PERIODS) -> list[Step]:
    return [(source, "mean", p, f"sma{p}") for p in periods]


def sma(df: DataFrame, source: str = "close", periods=SMA_PERIODS) -> DataFrame:
    return ewm(df, sma_steps(source, periods))


def highlow_steps(windows=EXTREME_WINDOWS) -> list[Step]:
    return [s for w in windows for s in (("low", "min", w, f"min{w}"), ("high", "max", w, f"max{w}"))]


def highlows(df: DataFrame, windows=EXTREME_WINDOWS) -> DataFrame:
    return ewm(df, highlow_steps(windows))


def change(now: Column, before: Column) -> Column:
    """Change in per cent."""
    return round32((F.try_divide(now, before) - 1) * 100, 2)


def rate_of_change(df: DataFrame, source: str = "close", periods=CHANGE_PERIODS) -> DataFrame:
    return df.withColumns({f"pct{p}": change(col(source), lag(col(source), p)) for p in periods})


def day_range() -> Column:
    """The range of a day in per cent of its low."""
    return (F.try_divide(col("high"), col("low")) - 1) * 100


def adr(df: DataFrame, period: int = 20) -> DataFrame:
    """Average daily range in per cent."""
    return df.withColumn("adr" if period == 20 else f"adr{period}", full(F.avg, day_range(), period).cast("float"))


def bands(mid: Column, dev: Column, multiplier: float = 2.0, tail: str = "") -> dict[str, Column]:
    return {f"bbtop{tail}": mid + multiplier * dev, f"bbbot{tail}": mid - multiplier * dev}


def bollinger(df: DataFrame, period: int = 20, multiplier: float = 2.0) -> DataFrame:
    tail = "" if (period, multiplier) == (20, 2.0) else f"_{period}_{multiplier:g}"
    return df.withColumns(bands(full(F.avg, col("close"), period), full(F.stddev_samp, col("close"), period), multiplier, tail))


def _log_ratio(n: Column, d: Column) -> Column:
    """ln(n/d), null where it is not defined."""
    return F.ln(F.try_divide(n, d))


def realized_volatility(df: DataFrame, source: str = "close", trading_periods: int = 252, windows=(20,)) -> DataFrame:
    step = df.withColumn("__r", _log_ratio(col(source), lag(col(source))))
    return step.withColumns({f"rv{w}": (full(F.stddev_pop, F.col("__r"), w) * math.sqrt(trading_periods) * 100).cast("float") for w in windows}).drop("__r")


def yang_zhang(df: DataFrame, window: int = 20, annualize_factor: float = 252.0) -> DataFrame:
    k = 0.34 / (1 + (window + 1) / (window - 1))
    o, h, low, c = (col(x) for x in ("open", "high", "low", "close"))
    step = df.withColumns({
        "__on": _log_ratio(o, lag(c)), "__oc": _log_ratio(c, o),
        "__rs": _log_ratio(h, c) * _log_ratio(h, o) + _log_ratio(low, c) * _log_ratio(low, o),
    })
    var = full(F.var_samp, F.col("__on"), window) + k * full(F.var_samp, F.col("__oc"), window) + (1 - k) * full(F.avg, F.col("__rs"), window)
    return step.withColumn("yz_variance", var * annualize_factor).withColumn("yz_vol", F.sqrt(F.col("yz_variance"))).drop("__on", "__oc", "__rs")


def beyond(high: Column, low: Column) -> dict[str, Column]:
    return {"high252": col("close") > high, "low252": col("close") < low}


def breakout_flags(df: DataFrame) -> DataFrame:
    """Close beyond the previous row's 252-row extreme; null on a ticker's first row."""
    return df.withColumns(beyond(lag("max252"), lag("min252")))


def dollar_volume(df: DataFrame) -> DataFrame:
    return df.withColumn("volumeusd", col("close") * col("volume"))


VOLUME_STEPS = [("volume", "mean", 60, "avgvolume60"), ("volumeusd", "mean", 20, "avgvolumeusd20"), ("volumeusd", "mean", 126, "avgvolumeusd126")]


def volume_averages(df: DataFrame) -> DataFrame:
    return ewm(df, VOLUME_STEPS)


def volume_roc(df: DataFrame) -> DataFrame:
    long = col("avgvolumeusd126")
    return df.withColumn("volumeroc", F.when(long > 0, safe_div("avgvolumeusd20", "avgvolumeusd126") - 1).cast("float"))


def rs_raw(df: DataFrame) -> DataFrame:
    parts = tuple(zip((0.4, 0.2, 0.2, 0.2), RS_PERIODS, strict=True))
    return df.withColumn("__rs", sum((w * col(f"pct{p}") for w, p in parts[1:]), parts[0][0] * col("pct63")).cast("float"))


def volume_confirmed(df: DataFrame) -> DataFrame:
    return df.withColumn("__volconfirm", (col("rsrank") - 50) / 50 * (col("volumerocrank") / 100))


def pressure(last: Column) -> Column:
    """Volume by the direction of the close since ``last`` and its place in the day's range."""
    c, h, low = col("close"), col("high"), col("low")
    inside = F.when(h - low > 0, F.try_divide(2 * c - h - low, h - low)).otherwise(F.lit(0.0))
    return (0.7 * F.signum(c - last) + 0.3 * inside) * col("volume")


def by_usual_volume(value: Column) -> Column:
    usual = col("avgvolume60")
    return F.when(usual > 0, F.try_divide(value, usual))


def accumulation(close: Held, high: Held, low: Held, volume: Held, last: Held, usual: Held) -> np.ndarray:
    """``pressure`` by usual volume, over arrays."""
    wide = high.x - low.x
    flat = high.null | low.null | (wide <= 0)
    inside = np.where(flat, 0.0, (2 * close.x - high.x - low.x) / np.where(flat, 1.0, wide))
    some = usual.x > 0
    return np.where(some, (0.7 * np.sign(close.x - last.x) + 0.3 * inside) * volume.x / np.where(some, usual.x, 1.0), np.nan)


def close_location(df: DataFrame) -> DataFrame:
    """Raw accumulation score: pressure by usual volume."""
    return df.withColumn("__ad", by_usual_volume(pressure(lag(col("close")))))
