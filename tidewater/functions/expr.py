"""Null, NaN and division rules in one place; other modules never divide with a bare ``/``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(x: Column | str) -> Column:
    return F.col(x).cast("double") if isinstance(x, str) else x


def finite(x: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(x) & (F.abs(x) < INF), x)


def safe_div(n: Column | str, d: Column | str) -> Column:
    """Quotient, null where it is not finite."""
    return finite(F.try_divide(col(n), col(d)))


def ieee_div(n: Column, d: Column) -> Column:
    """Quotient with IEEE results for a zero divisor."""
    zero = F.when(n > 0, F.lit(INF)).when(n < 0, F.lit(-INF)).when(n == 0, F.lit(float("nan")))
    return F.when(d == 0, zero).otherwise(F.try_divide(n, d))


#: Lifts values that arithmetic left a few last bits below a tie; the same on every engine.
NUDGE = 1.0000000000001


def rnd(x: Column, digits: int) -> Column:
    """Rounded half away from zero."""
    return F.round(x * NUDGE, digits)


def rnd_column(x: Column, digits: int) -> Column:
    """``rnd`` of a column, which costs nothing to read twice: in doubles as long as they hold its digits, without a decimal per value."""
    lifted, scale = x * NUDGE, 10.0**digits
    whole = lifted * scale
    return F.when(F.abs(whole) < 2.0**53, F.rint(whole) / scale + 0.0).otherwise(F.round(lifted, digits))


def round32(x: Column, digits: int) -> Column:
    return rnd(x, digits).cast("float")


def pct(x: Column) -> Column:
    """Per cent with one decimal."""
    return rnd(finite(100 * x), 1)


def ratio(n: Column | str, d: Column | str) -> Column:
    """Quotient with three decimals."""
    return rnd(safe_div(n, d), 3)


def nonzero(x: Column | str) -> Column:
    x = col(x)
    return F.when(x != 0, x)
