import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewater.operators import blocks, tables, technical
from tidewater.operators.ewm import of_row

def steps():
    return [
        ("x", "mean", 3, "m3"), ("x", "mean", 200, "m200"), ("x", "min", 252, "lo"), ("x", "max", 55, "hi"), ("x", "max", 4, "hi4"), ("x", "min", 1, "lo1"), ("x", "std", 20, "sd"),
        ("lo", "lag", 1, "lo_before"), ("x", 2 / 13, 12, "fast"), ("x", 2 / 67, 26, "slow"), ("x", 0.001, 1, "lazy"), ("y", 0.06, 1, "rec", False), ("y", 0.5, 3, "half"),
        of_row(F.col("fast") - F.col("slow"), "line", "fast", "slow"), ("line", 0.2, 9, "signal"),
    ]


def by_pandas(rows):
    """The steps over one key's frame in order, as pandas defines them."""
    x, y = rows["x"], rows["y"]
    weighted = lambda v, a, n, adjust=True: v.ewm(alpha=a, min_periods=n, adjust=adjust, ignore_na=True).mean()
    out = {"m3": x.rolling(3).mean(), "m200": x.rolling(200).mean(), "lo": x.rolling(252).min(), "hi": x.rolling(55).max(), "hi4": x.rolling(4).max(), "lo1": x, "sd": x.rolling(20).std()}
    out |= {"lo_before": out["lo"].shift(1), "fast": weighted(x, 2 / 13, 12), "slow": weighted(x, 2 / 67, 26), "lazy": weighted(x, 0.001, 1), "rec": weighted(y, 0.06, 1, False), "half": weighted(y, 0.5, 3)}
    out["line"] = out["fast"] - out["slow"]
    return pd.DataFrame(out | {"signal": weighted(out["line"], 0.2, 9)})


def some_rows(rng, n, gaps):
    x = 100 + np.cumsum(rng.normal(size=n))
    x[n // 3] = 1e9  # one value that dwarfs the others
    y = rng.normal(size=n)
    x[rng.random(n) < gaps], y[rng.random(n) < 0.98 if gaps else np.zeros(n, bool)] = np.nan, np.nan
    return x, y


def agree(got, want):
    for name in want.columns:
        a, b = got[name].to_numpy(float), want[name].to_numpy(float)
        assert (np.isnan(a) == np.isnan(b)).all(), name
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-6 if name == "sd" else 1e-9, err_msg=name)


@pytest.mark.parametrize("gaps", [0.0, 0.004])
def test_one_long_ticker(spark, gaps):
    """100,000 rows of one key over about a hundred blocks, some values missing, some columns nearly empty."""
    n = 100_000
    x, y = some_rows(np.random.default_rng(7), n, gaps)
    # pandas' sliding sums keep the trace of the large value, so frames are checked on centred sums of its own
    df = spark.createDataFrame(pd.DataFrame({"ticker": "A", "at": np.arange(n), "x": x, "y": y}).sample(frac=1, random_state=1))
    got = blocks.run_steps(df, steps(), "ticker", "at")
    assert "Python" not in got._jdf.queryExecution().toString() and "Pandas" not in got._jdf.queryExecution().toString()
    rows = got.toPandas().sort_values("at").reset_index(drop=True)
    want = by_pandas(pd.DataFrame({"x": x, "y": y}))
    full = np.lib.stride_tricks.sliding_window_view(x, 200).mean(1)
    want["m200"] = np.r_[np.full(199, np.nan), full]
    want["m3"] = np.r_[np.full(2, np.nan), np.lib.stride_tricks.sliding_window_view(x, 3).mean(1)]
    want["sd"] = np.r_[np.full(19, np.nan), np.lib.stride_tricks.sliding_window_view(x, 20).std(1, ddof=1)]
    agree(rows, want)


def test_many_short_tickers_of_small_blocks(spark, monkeypatch):
    """Histories of 1 to 900 rows, date keys, a null key, blocks of 64 rows."""
    monkeypatch.setattr(blocks, "ROWS", 64)
    rng, parts = np.random.default_rng(3), []
    for k, n in enumerate((1, 2, 63, 64, 65, 300, 900)):
        x, y = some_rows(rng, n, 0.01)
        parts.append(pd.DataFrame({"ticker": None if k == 3 else f"T{k}", "date": [dt.date(2010, 1, 1) + dt.timedelta(days=3 * i) for i in range(n)], "x": x, "y": y}))
    df = spark.createDataFrame(pd.concat(parts), "ticker string, date date, x double, y double")
    got = blocks.run_steps(df, steps()).toPandas()
    assert len(got) == sum(map(len, parts))
    for part in parts:
        name = part["ticker"].iloc[0]
        own = got[got["ticker"].isna() if name is None else got["ticker"] == name].sort_values("date").reset_index(drop=True)
        want = by_pandas(part.reset_index(drop=True))
        for c in ("m3", "m200", "sd"):
            for i in range(len(part)):
                w = {"m3": 3, "m200": 200, "sd": 20}[c]
                cut = part["x"].to_numpy()[max(0, i - w + 1) : i + 1]
                want.loc[i, c] = np.nan if len(cut) < w else cut.std(ddof=1) if c == "sd" else cut.mean()
        agree(own, want)


@pytest.mark.parametrize("kind", ["timestamp", "bigint", "string", "date"])
def test_order_keys(spark, kind):
    """Any ordered type may number the rows; nulls come first."""
    at = {"timestamp": "timestamp_seconds(id * 7000)", "bigint": "id * 900 - 5000", "string": "lpad(id, 5, '0')", "date": "date_add(date'2001-01-01', cast(id as int))"}[kind]
    df = spark.range(200).selectExpr("'A' ticker", f"case when id > 0 then {at} end at", "id")
    assert blocks.numbered(df, "ticker", "at").where("__row != id or __rows != 200").count() == 0


def test_last_dates_of_long_histories(spark, monkeypatch):
    """The last rows of a pruned pass are those of the whole one; tickers end on different dates, over many blocks."""
    monkeypatch.setattr(blocks, "ROWS", 64)
    rng, rows = np.random.default_rng(11), []
    for k, (first, n) in enumerate(((0, 700), (100, 500), (650, 50), (0, 640), (690, 10))):
        p = 50 + np.cumsum(rng.normal(size=n)) * 0.1
        rows += [(f"T{k}", dt.date(2015, 1, 1) + dt.timedelta(days=first + i), p[i], p[i] + 1, p[i] - 1, p[i] + 0.3, float(1000 + i % 37)) for i in range(n)]
    bars = spark.createDataFrame([tuple(float(v) if isinstance(v, np.floating) else v for v in r) for r in rows], "ticker string, date date, open double, high double, low double, close double, volume double")
    tickers = spark.createDataFrame([("T0",), ("T1",), ("T3",)], "ticker string")
    last = technical.technical_last(bars, tickers).toPandas().sort_values(["date", "ticker"]).reset_index(drop=True)
    whole = technical.technical_daily(bars).toPandas()
    dates = {max(r[1] for r in rows if r[0] == t) for t in ("T0", "T1", "T3")}
    want = whole[whole["date"].isin(dates)].sort_values(["date", "ticker"]).reset_index(drop=True)
    assert len(dates) == 3 and list(last.columns) == list(whole.columns)
    pd.testing.assert_frame_equal(last, want, rtol=1e-12)


def test_repeated_dates_fail_in_the_plan(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, d), *[1.0] * 5) for d in (1, 2, 2)], "ticker string, date date, open double, high double, low double, close double, volume double")
    with pytest.raises(PySparkException, match="repeated"):
        technical.technical_daily(df).count()


def test_limits_of_steps(spark):
    df = spark.range(3).selectExpr("'A' ticker", "id date", "cast(id as double) x")
    with pytest.raises(ValueError):
        blocks.run_steps(df, [("x", 0.5, 1, "w"), ("w", "mean", 3, "m")])
    with pytest.raises(ValueError):
        blocks.run_steps(df, [("x", 1.0, 1, "w")])
    assert blocks.run_steps(df.limit(0), [("x", 0.5, 1, "w"), ("x", "mean", 3, "m")]).count() == 0


def test_later_rows_from_the_stored_state(spark, monkeypatch):
    """Rows that come in parts get the columns of one pass: new keys, keys that pause, sparse columns, a part of one time, parts over several blocks."""
    monkeypatch.setattr(blocks, "ROWS", 64)
    rng, parts = np.random.default_rng(13), []
    for k, (first, n) in enumerate(((0, 900), (0, 310), (350, 40), (500, 400), (0, 899))):
        x, y = some_rows(rng, n, 0.01)
        parts.append(pd.DataFrame({"ticker": None if k == 4 else f"T{k}", "at": np.arange(first, first + n), "x": x, "y": y}))
    df = spark.createDataFrame(pd.concat(parts), "ticker string, at long, x double, y double").cache()
    whole = blocks.run_steps(df, steps(), "ticker", "at").toPandas().sort_values(["ticker", "at"]).reset_index(drop=True)
    state, got = None, []
    for a, b in ((0, 300), (300, 301), (301, 900)):
        rows, state = blocks.advance(df.where(f"at >= {a} and at < {b}"), steps(), state, "ticker", "at")
        got.append(rows.toPandas())
    assert state.tail.count() == 4 * 252 + 40 and state.tail.where("__row >= 0 or __row < -252").count() == 0
    done = pd.concat(got).sort_values(["ticker", "at"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(done, whole, rtol=1e-9, atol=1e-9)
    with pytest.raises(PySparkException, match="not after"):
        blocks.advance(df.where("at = 5"), steps(), state, "ticker", "at")[0].count()
    df.unpersist()


def test_appended_dates_are_not_added_twice(spark):
    rows = [(t, dt.date(2020, 1, 1) + dt.timedelta(days=i), 5.0, 6.0 + i % 3, 4.0, 5.0 + i % 5 / 10, 10.0 + i) for t in "AB" for i in range(60)]
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    tables.start_prices(bars.where("date < '2020-02-01'"), "t_")
    assert tables.append_prices(spark, bars.where("date >= '2020-02-01'"), "t_").count() == 120
    with pytest.raises(ValueError):
        tables.append_prices(spark, bars.where("date >= '2020-02-01'"), "t_")
    assert tables.append_prices(spark, bars.limit(0), "t_").count() == 120
    got = spark.table("t_stock_prices").toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    want = technical.technical_daily(bars).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-9)


def test_array_forms_are_their_expressions(spark):
    """Over nulls, NaN, infinities, days without a range or volume."""
    rng, odd = np.random.default_rng(5), [None, float("nan"), float("inf"), float("-inf"), 0.0, -2.0]
    rows = [("A", i, *[odd[rng.integers(6)] if rng.random() < 0.3 else float(rng.integers(1, 4)) for _ in range(6)]) for i in range(600)]
    df = spark.createDataFrame(rows, "ticker string, date long, high double, low double, close double, volume double, __close_1 double, avgvolume60 double")
    df = df.withColumns({"__fast": F.col("high"), "__slow": F.col("low")})
    forms = [s for s in technical.series_steps() if len(s) == 5 and not isinstance(s[1], float)]
    assert len(forms) == 5
    read = [(s[3], "max", 1, f"{s[3]}_read") for s in forms]  # what a later step sees
    by_array, by_column = (blocks.run_steps(df, [*steps, *read]).toPandas().sort_values("date") for steps in (forms, [s[:4] for s in forms]))
    for *_, out in read:
        np.testing.assert_array_equal(by_array[out].to_numpy(float), by_column[out].to_numpy(float), err_msg=out)


def test_rows_are_made_wide_once(spark):
    """One pass for the percentiles over narrow rows, one for the table, and no shuffle of the table's columns."""
    rows = [(t, dt.date(2020, 1, 1) + dt.timedelta(days=i), 5.0, 6.0, 4.0, 5.0, 10.0) for t in "AB" for i in range(3)]
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    plan = technical.technical_daily(bars)._jdf.queryExecution().sparkPlan().toString()
    wide = plan[: plan.index("MapInArrow")]
    assert plan.count("MapInArrow") == 2 and "Window" not in wide and "RepartitionByExpression" not in wide and "Exchange" not in wide


def test_tables_leave_nothing_on_the_way_and_come_in_order(spark):
    from pathlib import Path

    rows = [(f"T{k}", dt.date(2020, 1, 1) + dt.timedelta(days=i), 5.0, 6.0 + i % 3, 4.0, 5.0 + i % 5 / 10, 5.0 + i % 5 / 10, 10.0 + i) for k in range(12) for i in range(30)]
    source = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, closeadj double, volume double")
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    had = {p.name for p in root.iterdir()} if root.exists() else set()
    made = tables.build_tables({"stocks_prices": source}, "2020-03-01", ("stock_prices", "stock_prices_weekly"), "p_")
    assert sorted(p.name.partition("-")[0] for p in root.iterdir() if p.name not in had) == ["table", "table"]
    assert made["stock_prices"].count() == 360
    ends = []
    for file in sorted(f.removeprefix("file:") for f in made["stock_prices"].inputFiles()):
        part = pd.read_parquet(file, columns=["ticker", "date"]).apply(tuple, axis=1).tolist()
        assert part == sorted(part)
        ends += [part[0], part[-1]] if part else []
    assert ends == sorted(ends)


def test_last_rows_by_dates_alone(spark):
    """As ``latest_per_key``, null keys and dates included, and no wide rows sorted for it."""
    day = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("A", day, 1.0), ("A", day + dt.timedelta(days=1), 2.0), ("A", None, 3.0), (None, day, 4.0), ("B", None, 5.0)], "ticker string, date date, x double")
    got, want = (sorted(map(str, f.collect())) for f in (tables._newest(df), tables.latest_per_key(df, "date")))
    assert got == want and len(got) == 3


def test_series_are_dealt_once_and_percentiles_beside_them(spark):
    """The wide pass gets bars and percentiles in one deal without a join; what it does not read is not dealt, and bars that are files are not written again."""
    from pathlib import Path

    rows = [(t, dt.date(2020, 1, 1) + dt.timedelta(days=i), 5.0, 6.0, 4.0, 5.0 + i, 10.0) for t in ("A", None) for i in range(3)]
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    had = {p.name for p in root.iterdir()} if root.exists() else set()
    df = technical.technical_daily(bars, 100, written=True)
    assert sorted(p.name.partition("-")[0] for p in root.iterdir() if p.name not in had) == ["long"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 2 and "volumeusd" not in plan[plan.rindex("RepartitionByExpression") :]
    got = {(r["ticker"], r["date"].day): r["close"] for r in df.collect()}
    assert got == {(r[0], r[1].day): r[5] for r in rows}


def test_rows_beside_the_rows_they_belong_to(spark):
    """Columns made across keys come back to every row, over long and short keys, null keys and empty strings, with rows that have none."""
    rows = [(k, i, float(i % 7)) for k, n in (("A", 9000), ("B", 30), (None, 5), ("", 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "ticker string, at long, x double")
    across = ([("x", "mean", 2, "m")], ("m",), lambda r: r.where("at % 3 != 1").select("__key", "__block", "at", (F.col("m") * 10).alias("tenfold")))
    got = blocks.run_steps(df, [("x", "mean", 2, "m"), ("x", 0.5, 1, "w")], "ticker", "at", across=across).toPandas()
    assert len(got) == len(rows) and got["ticker"].isna().sum() == 5 and (got["ticker"] == "").sum() == 4
    shown = got["at"] % 3 != 1
    assert got.loc[~shown, "tenfold"].isna().all()
    np.testing.assert_allclose(got.loc[shown, "tenfold"].to_numpy(float), got.loc[shown, "m"].to_numpy(float) * 10)
    last = got[got["ticker"] == "A"].sort_values("at")["w"].iloc[-1]
    assert last == pytest.approx(sum((8999 - k) % 7 * 0.5 ** (k + 1) for k in range(60)), rel=1e-12)


def test_state_is_made_of_the_columns_it_needs(spark):
    """What weighted means leave is made without dealing columns that none of them reads."""
    df = spark.range(40).selectExpr("'A' ticker", "id at", "cast(id as double) x", "id * 3.0 y", "uuid() z")
    plan = blocks.Plan([("x", 0.5, 1, "w"), of_row(F.col("w") * 2, "twice", "w"), ("twice", 0.2, 1, "v"), ("y", "mean", 3, "m")])
    dealt = plan.left(blocks.lay(df, plan.reach, "ticker", "at"), None)._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in dealt.splitlines() if "Relation [" in line]
    assert scans and "MapInArrow" in dealt
    for part in dealt.split("RepartitionByExpression")[1:]:
        assert not re.search(r"\b[yz]#", part.partition("Relation [")[0])
