"""Percentile ranks by date, by report period and over a snapshot, and score blends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.expr import col, rnd, round32
from tidewater.operators.panel import asof_join, period_universe
from tidewater.sources.datasets import cut


def _order(value: Column, keys: list, ascending: bool):
    """One window order for rank, ties and number, so that they share a sort."""
    return Window.partitionBy(*keys).orderBy(value.asc_nulls_last() if ascending else value.desc_nulls_last())


def _place(value: Column, keys: list, ascending: bool, ties: str) -> Column:
    within = _order(value, keys, ascending)
    if ties == "dense":
        return F.dense_rank().over(within)
    return F.rank().over(within) + (F.count(value).over(within.rangeBetween(Window.currentRow, Window.currentRow)) - 1) / 2


def _number(value: Column, keys: list, ascending: bool) -> Column:
    return F.count(value).over(_order(value, keys, ascending).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def percentile(df: DataFrame, source: str, by: str, ascending: bool, alias: str, ties: str = "average", singleton: float | None = None, narrow: bool = True) -> DataFrame:
    """(rank - 1) / (n - 1) * 100 among rows with the same ``by``; ``singleton`` where n is one; a double unless ``narrow``."""
    x = F.when(~F.isnan(col(source)), col(source))
    n = _number(x, [F.col(by)], ascending)
    score = F.when(n > 1, F.try_divide(_place(x, [F.col(by)], ascending, ties) - 1, n - 1) * 100).otherwise(F.lit(singleton))
    return df.withColumn(alias, (round32 if narrow else rnd)(F.when(x.isNotNull(), score), 2))


def snapshot_percentiles(df: DataFrame, specs: list[tuple[str, bool, str]], key: str = "ticker") -> DataFrame:
    """Percentiles over all rows of a snapshot, (source, ascending, alias) each; one row scores 100.

    Metrics are unpivoted and their values counted, so repeated values meet before the
    shuffle.  Distinct values are then dealt by ranges of (metric, value), ranked within
    their range, and lifted by the counts of the ranges before; a metric is spread
    over as many tasks as its values need, and only the counts, one row a metric and
    range, are added up by metric.
    """
    entries = F.array(*[F.struct(F.lit(k).alias("metric"), (col(s) if up else -col(s)).alias("value")) for k, (s, up, _) in enumerate(specs)])
    long = df.select(key, F.explode(entries).alias("e")).select(key, "e.metric", "e.value").where("value is not null and not isnan(value)")
    scores = _scores(range_ranks(long.groupBy("metric", "value").agg(F.count("*").alias("k")), "metric", "value", "k"))
    scored = long.join(scores, ["metric", "value"])
    wide = scored.groupBy(key).pivot("metric", list(range(len(specs)))).agg(F.first("score"))
    named = wide.select(key, *[F.col(f"`{k}`").alias(alias) for k, (*_, alias) in enumerate(specs)])
    return df.drop(*[a for _, _, a in specs]).join(named, key, "left")


def _scores(ranked: DataFrame) -> DataFrame:
    score = F.when(F.col("n") > 1, (F.col("below") + (F.col("k") - 1) / 2) / F.greatest(F.col("n") - 1, F.lit(1)) * 100).otherwise(100.0)
    return ranked.select("metric", "value", round32(score, 2).alias("score"))


def range_ranks(values: DataFrame, by: str, value: str, count: str) -> DataFrame:
    """``values``, distinct in (by, value), with ``below``, the sum of ``count`` over smaller values of the same ``by``, and ``n``, the sum over all of them.

    The values are dealt by ranges and written with the number of their range, so that
    the counts of ranges and the ranks within them speak of the same deal.
    """
    dealt = cut(values.repartitionByRange(by, value).withColumn("__part", F.spark_partition_id()), "ranges")
    parts = dealt.groupBy(by, "__part").agg(F.sum(count).alias("__k"))
    before = F.sum("__k").over(Window.partitionBy(by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select(by, "__part", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__k").over(Window.partitionBy(by)).alias("n"))
    inside = F.sum(count).over(Window.partitionBy(by, "__part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1))
    local = dealt.withColumn("__inside", F.coalesce(inside, F.lit(0)))
    return local.join(offsets, [by, "__part"]).withColumn("below", F.col("__before") + F.col("__inside")).drop("__part", "__before", "__inside")


def weighted_score(weighted: list[tuple[str, float]], min_coverage: float) -> Column:
    """Mean of the present scores by weight; null if they carry less than ``min_coverage`` of it."""
    total = sum(w for _, w in weighted)
    held = _sum(F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in weighted)
    value = _sum(F.coalesce(col(c), F.lit(0.0)) * w for c, w in weighted)
    return round32(F.when((held >= min_coverage * total - 1e-12) & (held > 0), F.try_divide(value, held)), 2)


def weighted_score_neutral(weighted: list[tuple[str, float]], min_coverage: float) -> Column:
    """Mean by weight with 50 for what is missing, under the same coverage rule."""
    total = sum(w for _, w in weighted)
    held = _sum(F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in weighted)
    value = _sum(F.coalesce(col(c), F.lit(50.0)) * w for c, w in weighted)
    return round32(F.when((held >= min_coverage * total - 1e-12) & (held > 0), value / total), 2)


def _sum(items) -> Column:
    items = list(items)
    return sum(items[1:], items[0])


def period_ranks(df: DataFrame, specs: list[tuple[str, bool, str, bool]], on: str = "reportperiod", time: str = "calendardate", key: str = "ticker", stale_days: int = 366) -> DataFrame:
    """Point-in-time ranks: at each report date a key's latest known report counts, up to ``stale_days`` old.

    A spec is (source, ascending, alias, percentile).  All specs share one as-of
    join; a report never sees later ones.  Every report with a date makes an anchor
    and extends its key's life, and the latest report counts even where it holds no
    value: a key is then unranked rather than ranked by an older report.
    """
    sources = list(dict.fromkeys(s for s, *_ in specs))
    one = df.where(f"{on} is not null").groupBy(key, on).agg(F.max_by(F.struct(*sources), F.col(time)).alias("r")).select(key, on, "r.*")
    known = asof_join(period_universe(one, one, on, stale_days, key), one, on, key, stale_days, sources).where(" or ".join(f"`{s}` is not null" for s in sources))
    for source, ascending, alias, as_percentile in specs:
        x = col(source)
        place = _place(x, [F.col(on)], ascending, "average")
        n = _number(x, [F.col(on)], ascending)
        value = F.when(n > 1, F.try_divide(place - 1, n - 1) * 100).otherwise(100.0) if as_percentile else place
        known = known.withColumn(alias, round32(F.when(x.isNotNull(), value), 2))
    return df.join(known.select(key, on, *[a for _, _, a, _ in specs]), [key, on], "left")


def weighted_period_rank(df: DataFrame, specs, weighted: list[tuple[str, float]], alias: str, min_coverage: float, **options) -> DataFrame:
    ranked = period_ranks(df, specs, **options)
    return ranked.withColumn(alias, weighted_score(weighted, min_coverage)).drop(*[a for _, _, a, _ in specs])

