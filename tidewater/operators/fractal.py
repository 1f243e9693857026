"""Hurst exponent by detrended fluctuation analysis, in sums of boxes.

A box's residual around its line does not change when a constant or a slope is
taken off the profile, so the residual of each box is a property of the ticker's
profile alone, and the profile may begin anew in each block of the series, with the
block's own mean taken off.  A box's sums come from those of half as many rows, and
a window's boxes are added up likewise, at the same precision for any length of
history; a task sorts its blocks once.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import col
from tidewater.operators.arrays import Held
from tidewater.operators.blocks import Step, run_steps
from tidewater.operators.ewm import before, of_row

#: floor(exp(...)) of log-spaced scales is sensitive to the last bit.
SCALES = {500: (7, 11, 17, 25, 38, 56, 84, 125), 100: (7, 9, 11, 13, 15, 18, 21, 24)}


def scales_for(window: int, count: int = 8) -> tuple[int, ...]:
    if window in SCALES:
        return SCALES[window]
    low, high = math.log(8), math.log(window / 4)
    return tuple(sorted({int(math.exp(low + (high - low) * k / (count - 1))) for k in range(count)}))


def _log_ratio(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """ln(n/d), NaN where it is not defined."""
    some = (n * d > 0) & np.isfinite(n) & np.isfinite(d)
    return np.log(np.where(some, n, 1.0) / np.where(some, d, 1.0), out=np.full(len(n), np.nan), where=some)


def _garman_klass(o: Held, h: Held, low: Held, c: Held) -> np.ndarray:
    return 0.5 * _log_ratio(h.x, low.x) ** 2 - (2 * math.log(2) - 1) * _log_ratio(c.x, o.x) ** 2


def _positive(v: Held) -> np.ndarray:
    return np.where(v.x > 0, v.x, np.nan)


def _signal(c: Held, last: Held, v: Held, variance: Held, usual: Held) -> np.ndarray:
    """Without any variance in the frame its least value holds."""
    some = (usual.x > 0) & (v.x >= 0)
    root = np.sqrt(np.where(some, v.x, np.nan) / np.where(some, usual.x, 1.0))
    return _log_ratio(c.x, last.x) * root / np.sqrt(np.fmax(variance.x, 1e-12))


def signal_steps(rows: int = 20) -> list[Step]:
    """The signal ``z``, from row ``rows`` on, and what it reads."""
    o, h, low, c, v = (col(x) for x in ("open", "high", "low", "close", "volume"))
    ln = lambda n, d: F.ln(F.try_divide(n, d))
    gk = 0.5 * F.pow(ln(h, low), F.lit(2.0)) - (2 * math.log(2) - 1) * F.pow(ln(c, o), F.lit(2.0))
    z = F.try_divide(ln(c, F.col("__close_1")) * F.sqrt(F.try_divide(v, F.col("__vbar"))), F.sqrt(F.greatest(F.col("__variance"), F.lit(1e-12))))
    return [
        before("close"), of_row(gk, "__gk", "open", "high", "low", "close", array=_garman_klass), of_row(F.when(v > 0, v), "__v", "volume", array=_positive),
        ("__gk", "some", rows, "__variance"), ("__v", "some", rows, "__vbar"), of_row(z, "z", "close", "__close_1", "volume", "__variance", "__vbar", array=_signal),
    ]


#: Columns of the signal's steps that only other steps read.
ON_THE_WAY = ("__gk", "__v", "__variance", "__vbar", "__close_1")


def exponent_step(window: int, reverse: bool = False) -> Step:
    return ("z", "exponent", window, "hurst", scales_for(window), reverse)


def hurst_signal(df: DataFrame, rows: int = 20, key: str = "ticker", time: str = "date") -> DataFrame:
    """Return over Garman-Klass volatility, times the root of relative volume, from row ``rows`` on."""
    return run_steps(df, signal_steps(rows), key, time, drop=ON_THE_WAY)


def hurst(df: DataFrame, window: int = 100, reverse: bool = False, key: str = "ticker", time: str = "date") -> DataFrame:
    """Append ``hurst`` to rows that have ``z``; null until the window is full of signals.

    ``reverse`` adds the boxes that are laid from the window's end to each scale's sum.
    ``time`` is a date, a timestamp, an integer or a string.
    """
    return run_steps(df, [exponent_step(window, reverse)], key, time)
