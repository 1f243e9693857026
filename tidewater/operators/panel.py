"""Entity time series: windows, as-of joins, latest rows, resampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, TIME = "ticker", "date"


def series(key: str = KEY, time: str = TIME):
    return Window.partitionBy(key).orderBy(time)


def trailing(w: int, key: str = KEY, time: str = TIME):
    return series(key, time).rowsBetween(-(w - 1), 0)


def full(agg, x: Column, w: int, key: str = KEY, time: str = TIME) -> Column:
    """An aggregate of the last ``w`` rows, null until all of them have a value."""
    frame = trailing(w, key, time)
    return F.when(F.count(x).over(frame) >= w, agg(x).over(frame))


def lag(x: Column | str, n: int = 1, key: str = KEY, time: str = TIME) -> Column:
    return F.lag(x, n).over(series(key, time))


def assert_unique_key(df: DataFrame, *keys: str) -> DataFrame:
    """Fail if two rows share ``keys``; order-based windows would be ambiguous."""
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").take(1)
    if twice:
        raise ValueError(f"repeated key {keys}: {twice[0].asDict()}")
    return df


def stretch(df: DataFrame, time: str, rows: int = 1024) -> Column:
    """A coarse number that grows with ``time``, so that a stretch of a key is a small part of it: a year of dates, a day of timestamps."""
    kind = df.schema[time].dataType
    if isinstance(kind, T.DateType):
        return F.year(time)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.datediff(F.to_date(time), F.lit("1970-01-01"))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.floor(F.col(time) / rows)
    return F.lit(0)


def asof_join(left: DataFrame, right: DataFrame, on: str, by: str, tolerance_days: int, columns: list[str]) -> DataFrame:
    """``left`` with ``columns`` of the last row of ``right`` at or before ``on``, within the tolerance.

    Both sides are laid in one series per key and stretch of time, so no pair of rows is
    made and a key's history is spread over tasks.  A row whose stretch has no earlier row
    of ``right`` takes the last one of the stretches before, of which there is one row
    each.  ``right`` has one row per (by, on); a null key or time finds nothing.
    """
    found = F.struct(F.col(on).alias("at"), *[F.col(c) for c in columns])
    slot = lambda df: F.coalesce(stretch(df, on), F.lit(-(2**31))).cast("long").alias("__slot")
    l_ = left.select(F.col(by).alias("__by"), F.col(on).alias("__on"), slot(left), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row"), F.lit(None).alias("__hit"))
    r_ = right.where(F.col(by).isNotNull() & F.col(on).isNotNull()).select(F.col(by).alias("__by"), F.col(on).alias("__on"), slot(right), F.lit(0).alias("__side"), F.lit(None).alias("__row"), found.alias("__hit"))
    inside = Window.partitionBy("__by", "__slot").orderBy("__on", "__side").rowsBetween(Window.unboundedPreceding, 0)
    both = l_.unionByName(r_).withColumn("__hit", F.last("__hit", ignorenulls=True).over(inside)).where("__side = 1")
    ends = r_.groupBy("__by", "__slot").agg(F.max_by("__hit", "__on").alias("__hit"))
    slots = ends.unionByName(l_.select("__by", "__slot").distinct(), allowMissingColumns=True).groupBy("__by", "__slot").agg(F.first("__hit", ignorenulls=True).alias("__hit"))
    before = F.last("__hit", ignorenulls=True).over(Window.partitionBy("__by").orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1))
    carried = slots.where("__by is not null").select("__by", "__slot", before.alias("__before"))
    hit = both.join(carried, ["__by", "__slot"], "left").withColumn("__hit", F.coalesce("__hit", "__before"))
    near = F.col("__by").isNotNull() & (F.datediff("__on", F.col("__hit.at")) <= tolerance_days)
    return hit.select("__row.*", *[F.when(near, F.col(f"__hit.{c}")).alias(c) for c in columns])


def latest_per_key(df: DataFrame, time: str, key: str = KEY) -> DataFrame:
    """The last whole row of each key, nulls included; aggregates partially before the shuffle."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(time)).alias("__row")).select(key, "__row.*")


def resample_ohlcv(df: DataFrame, unit: str) -> DataFrame:
    """Bars per ``unit`` ('week', 'month', ...), labelled with the first trading date."""
    return (
        df.groupBy(KEY, F.date_trunc(unit, TIME).alias("__bucket"))
        .agg(
            F.min(TIME).alias(TIME), F.min_by("open", TIME).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", TIME).alias("close"), F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
        ).drop("__bucket")
    )


def period_universe(reports: DataFrame, anchors: DataFrame, on: str, stale_days: int = 366, key: str = KEY) -> DataFrame:
    """(key, anchor) for each anchor date within the life of a key, from its first report to ``stale_days`` after its last.

    Lives and anchors meet by year, so a key is compared only with the anchors of
    the years it lived in.
    """
    life = reports.groupBy(key).agg(F.min(on).alias("first"), F.date_add(F.max(on), stale_days).alias("last"))
    lived = life.withColumn("__year", F.explode(F.sequence(F.year("first"), F.year("last"))))
    dates = anchors.select(F.col(on).alias("anchor")).where("anchor is not null").distinct().withColumn("__year", F.year("anchor"))
    return lived.join(dates, "__year").where("anchor between first and last").select(key, F.col("anchor").alias(on))


def running_total(df: DataFrame, order: str, value: str, out: str, width: int = 1024) -> DataFrame:
    """Append ``out``, the sum of ``value`` over all rows with a smaller ``order`` (distinct integers of at least 0).

    Two levels: sums within stretches of ``width`` numbers, and the totals of the
    stretches before, so that a window holds one stretch or one row per stretch.
    """
    block = df.withColumn("__block", F.floor(F.col(order) / width))
    totals = block.groupBy("__block").agg(F.sum(value).alias("__total"))
    before = totals.select("__block", F.coalesce(F.sum("__total").over(Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    own = F.coalesce(F.sum(value).over(Window.partitionBy("__block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return block.join(before, "__block").withColumn(out, F.col("__before") + own).drop("__block", "__before")
