import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewater.operators import arrays, blocks, fractal
from tidewater.plans import registry


def test_frames_and_decayed_sums_of_two_blocks():
    rng = np.random.default_rng(5)
    place = np.concatenate([np.arange(300), np.arange(170)])
    x = np.where(rng.random(470) < 0.02, np.nan, rng.normal(size=470))
    for start, end in ((0, 300), (300, 470)):
        s = pd.Series(x[start:end])
        for n in (1, 7, 60, 126):
            for how in ("mean", "min", "max", "std"):
                want = getattr(s.rolling(n), how)()
                assert np.allclose(arrays.frame_value(x, place, how, n)[start:end], want, rtol=1e-12, atol=1e-12, equal_nan=True)
        whole = np.nan_to_num(x)
        want = [sum(whole[start + j] * 0.9 ** (i - j) for j in range(i + 1)) for i in range(end - start)]
        assert np.allclose(arrays.decayed(whole, place, 0.9)[start:end], want, rtol=1e-12)


def test_blocks_go_on_in_later_batches(spark):
    rows = spark.range(1000).select(F.lit("k").alias("__key"), F.floor(F.col("id") / 350).alias("__block"), F.col("id").alias("__row"), F.col("id").cast("double").alias("x"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        one = rows.coalesce(1).sortWithinPartitions("__row")
        done = arrays.appended(one, [one.schema["x"].__class__("before", one.schema["x"].dataType)], lambda b: b.made.update(before=b.lag("x", 100))).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = done.groupby("__block")["x"].shift(100)
    assert len(done) == 1000 and np.array_equal(done["before"], want, equal_nan=True)


def test_hurst_sorts_its_blocks_once(spark):
    """A sort for each scale held all rows of a task as often as there are scales."""
    df = spark.range(600).select(F.lit("a").alias("ticker"), F.col("id").alias("date"), F.rand(1).alias("z"))
    plan = fractal.hurst(df, 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") <= 2


def test_accumulation_score_lays_its_series_once(spark, sf_dir, monkeypatch):
    """It was laid, shuffled and written once for the volumes and once more for the score."""
    laid, lay = [], blocks.lay
    monkeypatch.setattr(blocks, "lay", lambda *a, **k: laid.append(1) or lay(*a, **k))
    registry.QUERIES["ad_score"](spark, sf_dir)
    assert len(laid) == 1
