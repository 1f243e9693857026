import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidewater.functions.expr import col, ieee_div, pct, safe_div
from tidewater.operators import ewm, exports, fractal, indicators, insiders, panel, rank, snapshot, statements, technical
from tidewater.sources import datasets

D = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("ticker", "date"))).collect()]


@pytest.fixture(scope="module")
def bars(spark):
    rows = [(t, D(i), 10.0 + i % 7, 12.0 + i % 7, 9.0 + i % 5, 10.5 + (i * 7) % 11 / 10, 100.0 + i) for t in ("A", "B") for i in range(60)]
    return spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")


def test_division(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0), (-1.0, 0.0)], "n double, d double")
    rows = df.select(safe_div("n", "d").alias("q"), ieee_div(col("n"), col("d")).alias("i"), pct(col("n")).alias("p")).collect()
    assert [r["q"] for r in rows] == [0.5, None, None, None, None]
    assert rows[1]["i"] == math.inf and math.isnan(rows[2]["i"]) and rows[4]["i"] == -math.inf and rows[0]["p"] == 100.0


@pytest.mark.parametrize(("step", "name", "first"), [
    (lambda d: indicators.sma(d, periods=(10,)), "sma10", 10), (lambda d: indicators.highlows(d, (20,)), "max20", 20), (lambda d: indicators.rate_of_change(d, periods=(5,)), "pct5", 6),
    (indicators.realized_volatility, "rv20", 21), (indicators.yang_zhang, "yz_vol", 21), (ewm.rsi, "rsi14", 14), (ewm.atr, "atr20", 21), (lambda d: ewm.adx(d, 14), "adx14", 28),
    (ewm.macd, "macd", 26), (ewm.macd, "macd_signal", 34), (ewm.ewma_vol, "ewma_vol", 2), (indicators.adr, "adr", 20), (indicators.bollinger, "bbtop", 20), (ewm.ema, "ema10", 10),
    (fractal.hurst_signal, "z", 20),
])
def test_warm_up(bars, step, name, first):
    values = column(step(bars), name)
    for half in (values[:60], values[60:]):
        assert next(i for i, v in enumerate(half, 1) if v is not None) == first and all(v is not None for v in half[first - 1 :])


def test_flat_series(spark):
    df = spark.createDataFrame([("A", D(i), 5.0, 5.0, 5.0, 5.0, 1.0) for i in range(20)], "ticker string, date date, open double, high double, low double, close double, volume double")
    assert all(v is None or math.isnan(v) for v in column(ewm.rsi(df), "rsi14"))
    up = df.withColumn("close", F.datediff("date", F.lit("2019-12-31")).cast("double"))
    assert column(ewm.rsi(up), "rsi14")[-1] == 100.0


def test_breakouts_stay_inside_a_ticker(bars):
    flags = column(indicators.breakout_flags(bars.withColumns({"max252": F.lit(1.0), "min252": F.lit(0.0)})), "high252")
    assert flags[0] is None and flags[60] is None and flags[1] is True


def test_eps_yield(spark):
    df = spark.createDataFrame([("A", D(i), 1.0 + (i == 4), 100.0) for i in range(5)], "ticker string, calendardate date, eps double, close double")
    got = df.select("calendardate", statements.eps_yield_delta(col("eps"), col("close")).alias("d")).orderBy("calendardate").collect()
    assert [r["d"] for r in got] == [None] * 4 + [1.0]


def test_asof(spark):
    left = spark.createDataFrame([("A", D(10)), ("A", D(30)), ("A", D(1)), ("B", D(10)), (None, D(10))], "ticker string, date date")
    right = spark.createDataFrame([("A", D(3), 1.0), ("A", D(10), None), ("A", D(15), 3.0), (None, D(9), 9.0)], "ticker string, date date, v double")
    rows = panel.asof_join(left, right, "date", "ticker", 10, ["v"]).collect()
    assert {(r["ticker"], r["date"]): r["v"] for r in rows} == {("A", D(10)): None, ("A", D(30)): None, ("A", D(1)): None, ("B", D(10)): None, (None, D(10)): None}
    assert {r["v"] for r in panel.asof_join(left, right, "date", "ticker", 15, ["v"]).where("date = '2020-01-31'").collect()} == {3.0}


def test_asof_of_a_hot_key_equals_sql(spark):
    """One key holds half of the rows over many years, with gaps of years, repeated left rows and rows before any match."""
    import duckdb
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    day = lambda n: [dt.date(2000, 1, 1) + dt.timedelta(days=int(d)) for d in n]
    keys = np.where(rng.random(4000) < 0.5, "HOT", rng.choice(list("ABCDE"), 4000))
    left = pd.DataFrame({"ticker": keys, "date": day(rng.integers(0, 9000, 4000)), "n": np.arange(4000)})
    right = pd.DataFrame({"ticker": np.where(rng.random(600) < 0.5, "HOT", rng.choice(list("ABCDE"), 600)), "date": day(rng.integers(1500, 9000, 600)), "v": rng.random(600)}).drop_duplicates(["ticker", "date"])
    right = right[(right["date"] < dt.date(2010, 1, 1)) | (right["date"] > dt.date(2014, 6, 1))]
    for days in (30, 3000):
        got = panel.asof_join(spark.createDataFrame(left), spark.createDataFrame(right), "date", "ticker", days, ["v"])
        want = duckdb.sql(f"SELECT n, CASE WHEN date_diff('day', CAST(r.date AS DATE), CAST(l.date AS DATE)) <= {days} THEN v END AS v FROM left_ l ASOF LEFT JOIN right_ r ON l.ticker = r.ticker AND l.date >= r.date".replace("left_", "left").replace("right_", "right").replace("FROM left l", 'FROM "left" l').replace("JOIN right r", 'JOIN "right" r')).fetchall()
        assert {r["n"]: r["v"] for r in got.collect()} == dict(want) and len(want) == 4000
    assert "hashpartitioning(__by" in (plan := got._jdf.queryExecution().executedPlan().toString()) and "__slot" in plan


def test_percentiles(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("b", 1, 5.0), ("c", 1, 9.0), ("d", 1, None), ("e", 2, 1.0)], "ticker string, date int, x double")
    assert column(rank.percentile(df, "x", "date", True, "p"), "p", "ticker") == [25.0, 25.0, 100.0, None, None]
    assert column(rank.percentile(df, "x", "date", False, "p", ties="dense", singleton=100.0), "p", "ticker") == [50.0, 50.0, 0.0, None, 100.0]
    assert column(rank.snapshot_percentiles(df, [("x", True, "p"), ("x", False, "q")]), "q", "ticker") == pytest.approx([50.0, 50.0, 0.0, None, 100.0])
    one = rank.snapshot_percentiles(df.where("ticker = 'e'"), [("x", True, "p")])
    assert one.first()["p"] == 100.0


def test_exponent_is_joined_while_rows_are_narrow(spark):
    rows = [(t, D(i), 10.0 + i % 7, 12.0 + i % 7, 9.0 + i % 5, 10.5 + (i * 7) % 11 / 10, 100.0 + i) for t in ("A", None) for i in range(130)]
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    done = technical.technical_daily(bars, 100)
    assert "Join" not in done._jdf.queryExecution().executedPlan().toString()
    assert done.columns == [*technical.technical_daily(bars).columns, "hurst"]
    want = column(fractal.hurst(fractal.hurst_signal(bars), 100), "hurst")
    assert column(done, "hurst") == want and len(want) == 260 and sum(v is not None for v in want) == 2 * 12


def test_weekly_table_has_the_exponent(spark):
    """The weekly table comes with the exponent over 100 weeks, as the tables that are written have it."""
    rows = [("A", D(7 * i + k), 10.0 + i % 7, 12.0 + i % 7, 9.0 + i % 5, 10.5 + (i * 7 + k) % 11 / 10, 100.0 + i) for i in range(125) for k in (0, 2)]
    bars = spark.createDataFrame(rows, "ticker string, date date, open double, high double, low double, close double, volume double")
    done = technical.technical_weekly(bars)
    want = column(fractal.hurst(fractal.hurst_signal(panel.resample_ohlcv(bars, "week")), 100), "hurst")
    assert column(done, "hurst") == want and sum(v is not None for v in want) == 7 and {"rsi14", "adrank"} <= set(done.columns)
    assert technical.technical_weekly(bars, None).columns == [c for c in done.columns if c != "hurst"]


def test_blends_take_unnarrowed_ranks_by_date(spark):
    """0.45 * 1.56 + 0.1 * 33.33 is 4.035: which way it rounds must not hang on 33.33 as a float."""
    df = spark.createDataFrame([(k, D(0), float(k), float(k), float(k)) for k in range(1, 5)], "ticker int, date date, __rs double, volumeroc double, ad double")
    ranked = technical.with_ranks(df)
    assert column(ranked, "volconfirmrank", "ticker") == [33.33, 0.0, 66.67, 100.0] and column(ranked, "adrank", "ticker") == [0.0, 33.33, 66.67, 100.0]
    blend = snapshot.momentum_rank(ranked.withColumn("growthrank", F.lit(0.0).cast("float")).withColumn("rsrank", F.lit(1.56).cast("float")))
    assert round(column(blend, "momrank", "ticker")[0], 2) == 4.03


def test_snapshot_rank_of_many_distinct_values(spark):
    """A million values in many ranges, with ties and gaps; no window has a metric's rows to itself."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 1_000_000
        df = spark.range(n).select(F.col("id").alias("ticker"), F.pmod(F.col("id") * 7919, F.lit(n)).cast("double").alias("x"), F.when(F.col("id") % 3 > 0, F.floor(F.col("id") / 1000)).cast("double").alias("y"))
        got = rank.snapshot_percentiles(df, [("x", True, "p"), ("x", False, "q"), ("y", True, "r")])
        far = got.select(
            F.max(F.abs(F.col("p") - F.col("x") / (n - 1) * 100)).alias("p"), F.max(F.abs(F.col("q") - (100 - F.col("x") / (n - 1) * 100))).alias("q"), F.count("r").alias("r"), F.count("*").alias("n"),
        ).first()
        assert far["p"] < 0.0051 and far["q"] < 0.0051 and far["n"] == n and far["r"] == n - -(-n // 3)
        r = got.where("ticker in (1, 500000, 999998)").orderBy("ticker").select("r").collect()
        m, group = n - -(-n // 3), lambda k: sum(i % 3 > 0 for i in range(k * 1000, k * 1000 + 1000))
        below = lambda k: k * 1000 - -(-k * 1000 // 3)
        assert [x["r"] for x in r] == pytest.approx([(below(k) + (group(k) - 1) / 2) / (m - 1) * 100 for k in (0, 500, 999)], abs=0.006)
        ranges = rank.range_ranks(df.select(F.lit(0).alias("metric"), "x", F.lit(1).alias("k")), "metric", "x", "k")
        assert ranges.where("below != x or n != 1000000").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_period_rank_uses_known_reports_only(spark):
    rows = [("A", D(0), 1.0), ("B", D(100), 2.0), ("C", D(700), 5.0), ("A", D(400), 3.0), ("D", D(401), None)]
    df = spark.createDataFrame([(t, d, d, v) for t, d, v in rows], "ticker string, reportperiod date, calendardate date, value double")
    got = rank.period_ranks(df, [("value", True, "p", True), ("value", False, "r", False)])
    at = {(r["ticker"], r["reportperiod"]): (r["p"], r["r"]) for r in got.collect()}
    assert at["A", D(0)] == (100.0, 1.0) and at["B", D(100)] == (100.0, 1.0) and at["A", D(400)] == (100.0, 1.0) and at["C", D(700)] == (100.0, 1.0)
    assert at["D", D(401)] == (None, None)


def test_period_rank_of_an_empty_latest_report(spark):
    """A key whose latest report holds no value is unranked; an older report does not stand in."""
    rows = [("A", D(0), 1.0), ("A", D(90), None), ("B", D(90), 2.0), ("C", D(40), None)]
    df = spark.createDataFrame([(t, d, d, v) for t, d, v in rows], "ticker string, reportperiod date, calendardate date, value double")
    got = rank.period_ranks(df, [("value", True, "p", True), ("value", False, "r", False)])
    at = {(r["ticker"], r["reportperiod"]): (r["p"], r["r"]) for r in got.collect()}
    assert at == {("A", D(0)): (100.0, 1.0), ("A", D(90)): (None, None), ("B", D(90)): (100.0, 1.0), ("C", D(40)): (None, None)}


def test_repeated_reports_of_a_period(spark):
    """Of two reports with one (ticker, reportperiod) the later calendardate counts."""
    rows = [("A", D(0), D(0), 1.0), ("A", D(0), D(5), 9.0), ("B", D(0), D(0), 5.0)]
    df = spark.createDataFrame(rows, "ticker string, reportperiod date, calendardate date, value double")
    got = rank.period_ranks(df, [("value", True, "p", True)])
    assert {(r["ticker"], r["calendardate"]): r["p"] for r in got.collect()} == {("A", D(0)): 100.0, ("A", D(5)): 100.0, ("B", D(0)): 0.0}


def test_rolling_steps_and_gaps(spark):
    """A frame with a missing value has no aggregate; others match plain slices."""
    x = [3.0, 1.0, None, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([("A", D(i), v) for i, v in enumerate(x)], "ticker string, date date, v double")
    done = ewm.ewm(df, [("v", "mean", 3, "m"), ("v", "min", 3, "lo"), ("v", "max", 3, "hi"), ("v", "std", 3, "sd")]).orderBy("date").collect()
    for i, r in enumerate(done):
        part = x[max(0, i - 2) : i + 1]
        if len(part) < 3 or None in part:
            assert r["m"] is None and r["lo"] is None and r["sd"] is None
        else:
            mean = sum(part) / 3
            assert (r["m"], r["lo"], r["hi"], r["sd"]) == pytest.approx((mean, min(part), max(part), math.sqrt(sum((v - mean) ** 2 for v in part) / 2)))


def test_scores(spark):
    df = spark.createDataFrame([(90, 80, 70), (90, 80, None), (90, None, None), (None, None, None)], "a int, b int, c int")
    parts = [("a", 0.5), ("b", 0.25), ("c", 0.25)]
    rows = df.select(rank.weighted_score(parts, 0.6).alias("w"), rank.weighted_score_neutral(parts, 0.5).alias("n")).collect()
    assert [r["w"] for r in rows] == pytest.approx([82.5, 86.67, None, None], abs=1e-4) and [r["n"] for r in rows] == pytest.approx([82.5, 77.5, 70.0, None])


def test_resample_and_latest(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 1, d), 1.0 * d, 2.0 * d, 0.5, 1.5 * d, 10.0) for d in (2, 3, 5, 8)], "ticker string, date date, open double, high double, low double, close double, volume double")
    first, second = panel.resample_ohlcv(df, "week").orderBy("date").collect()
    assert (first["date"], first["open"], first["high"], first["close"], first["volume"]) == (dt.date(2024, 1, 2), 2.0, 10.0, 7.5, 30.0) and second["date"] == dt.date(2024, 1, 8)
    assert panel.latest_per_key(df.withColumn("close", F.when(F.dayofmonth("date") < 8, F.col("close"))), "date").first()["close"] is None
    with pytest.raises(ValueError):
        panel.assert_unique_key(df.unionAll(df), "ticker", "date")


def test_value_multiples(spark):
    df = spark.createDataFrame([(10.0, 2.0, 5.0, 4.0), (10.0, 2.0, 5.0, -1.0), (10.0, 2.0, 5.0, None), (-1.0, 2.0, 5.0, 1.0), (10.0, 0.0, 0.0, 1.0)], "ev double, ebitda double, revenue double, ebitda1y double")
    assert [r["__v_peg"] for r in snapshot.value_multiples(df).collect()] == [1.25, 1e9, None, None, None]


def test_titles(spark):
    rows = [(True, False, False, "CEO"), (True, False, False, None), (False, True, False, "x"), (False, False, True, None), (False, False, False, None), (None, None, None, "y")]
    df = spark.createDataFrame(rows, "isofficer boolean, isdirector boolean, istenpercentowner boolean, officertitle string")
    assert [r["officertitle"] for r in insiders.insider_titles(df).collect()] == ["CEO", "", "Director", "10% Owner", "", "y"]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("BRK/B", D(1), 1.0), ("A", D(0), 2.0)], "ticker string, date date, close double")
    exports.export_partitioned(df, str(tmp_path / "out"), ["date"])
    assert {p.name for p in (tmp_path / "out").glob("key=*")} == {"key=BRK_B", "key=A"}
    with pytest.raises(ValueError):
        datasets.save_table(df, "")


def test_exports_by_ticker(spark, tmp_path):
    """Latest and largest insider rows first, the key only in the folder's name, companies alone."""
    rows = [("A", D(1), 5.0, "P"), ("A", D(3), 1.0, None), ("A", D(3), 7.0, "S"), ("A", D(4), 1.0, "M"), ("Z", D(1), 1.0, "P")]
    df = spark.createDataFrame(rows, "ticker string, date date, transactionvalue double, transactioncode string")
    held = exports.of_companies(exports.no_other_codes(df), spark.createDataFrame([("A",), (None,)], "ticker string"))
    exports.export_partitioned(held, str(tmp_path / "ins"), list(exports.INSIDER_ORDER))
    back = spark.read.parquet(str(tmp_path / "ins"))
    assert "ticker" not in back.columns and [(r["key"], r["date"], r["transactionvalue"]) for r in back.collect()] == [("A", D(3), 7.0), ("A", D(3), 1.0), ("A", D(1), 5.0)]


def test_a_large_ticker_is_several_files_in_order(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("case when id % 10 < 8 then 'HOT' else concat('T', id % 97) end ticker", "date_add(date'1950-01-01', cast(id as int)) date", "cast(id as double) close")
        exports.export_partitioned(df, str(tmp_path / "out"), [(F.desc, "date")])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = sorted((tmp_path / "out" / "key=HOT").glob("part-*.parquet"))
    days = [r["date"] for f in files for r in spark.read.parquet(str(f)).collect()]
    assert len(files) > 3 and len(days) == 16_000 and days == sorted(days, reverse=True)
    assert len(list((tmp_path / "out").glob("key=T*/part-*"))) < 2 * 97


def test_tables_replace_whole_and_leave_no_old_files(spark):
    from pathlib import Path

    one = datasets.save_table(spark.range(10).selectExpr("id a"), "tidewater_t", order=("a",))
    first = datasets.table_location(spark, "tidewater_t")
    assert one.count() == 10
    datasets.save_table(one.selectExpr("a + 1 a"), "tidewater_t", explain=True)  # reads the table that it replaces
    second = datasets.table_location(spark, "tidewater_t")
    assert sorted(r["a"] for r in spark.table("tidewater_t").collect()) == list(range(1, 11)) and first != second
    assert not Path(first.removeprefix("file:")).exists() and Path(second.removeprefix("file:")).exists()
    assert datasets.save_table(spark.range(3).selectExpr("id a", "'x' b"), "tidewater_t").columns == ["a", "b"]
    spark.sql("DROP TABLE tidewater_t")


def test_stale_companies_are_left_out(spark):
    from tidewater.operators import tables

    co = spark.createDataFrame([(t, *[t] * 10, "N") for t in "AB"], ", ".join(f"{c} string" for c in [*snapshot.COMPANY, "isdelisted"]))
    prices = spark.createDataFrame([("A", D(100), 1.0), ("B", D(60), 1.0)], "ticker string, date date, close double")
    ttm = spark.createDataFrame([(t, D(50), 1.0, 1.0, 1.0, 1.0) for t in "AB"], "ticker string, calendardate date, sharesbas double, netdebt double, netinc double, revenuecagr3y double")
    qtr = spark.createDataFrame([(t, D(50), *[1.0] * len(snapshot.QUARTERLY)) for t in "AB"], "ticker string, calendardate date, " + ", ".join(f"{c} double" for c in snapshot.QUARTERLY))
    held = lambda days: {r["ticker"] for r in snapshot.company_base(co, prices, ttm, qtr, days).collect()}
    assert held(None) == {"A", "B"} and held(40) == {"A", "B"} and held(39) == {"A"}
    with pytest.raises(ValueError):
        tables.build_tables({}, "2020-01-01", ("nothing",))


def test_every_export_is_written(spark, sf_dir, tmp_path):
    from tidewater.plans import registry as R
    from tidewater.sources.fixtures import AS_OF, view

    companies = datasets.cut(R.companies(spark, sf_dir))
    insider = insiders.insiders(view(spark, sf_dir, "ins"), AS_OF)
    exports.export_files(str(tmp_path), companies, R.bars(spark, sf_dir), R.ttm(spark, sf_dir), R.qtr(spark, sf_dir), insider, AS_OF)
    assert {p.name for p in tmp_path.iterdir()} == {"companies", "search", "insiders", "metrics_by_ticker", "ttm_by_ticker", "qtr_by_ticker", "insiders_by_ticker", "prices_by_ticker"}
    tickers = {r["ticker"] for r in companies.select("ticker").collect()}
    for name in ("metrics", "ttm", "qtr", "prices"):
        back = spark.read.parquet(str(tmp_path / f"{name}_by_ticker"))
        assert {str(r["key"]) for r in back.select("key").distinct().collect()} == tickers and ("ticker" in back.columns) == (name == "metrics")
    assert spark.read.parquet(str(tmp_path / "search")).columns == ["exchange", "ticker", "name", "close", "pct1d"]


def test_dropped_columns(spark, sf_dir):
    from tidewater.sources.fixtures import view

    fin = view(spark, sf_dir, "fin").withColumns({"revenueusd": F.lit(1.0), "dimension": F.lit("ARQ")})
    assert not {"revenueusd", "dimension"} & set(statements.adjust_financials(fin).columns)


def exponent(z, window, reverse=False):
    """The definition: boxes of the window's profile, residuals around a line, slope over the logs of the scales."""
    import numpy as np

    profile, xs, ys = np.cumsum(z - z.mean()), [], []
    for s in fractal.scales_for(window):
        starts = [b * s for b in range(window // s)] + [window - (b + 1) * s for b in range(window // s) if reverse]
        x = np.arange(s)
        ss = sum(((profile[a : a + s] - np.polyval(np.polyfit(x, profile[a : a + s], 1), x)) ** 2).sum() for a in starts)
        xs.append(math.log(s))
        ys.append(0.5 * math.log(ss / (len(starts) * s)))
    return np.polyfit(xs, ys, 1)[0]


@pytest.mark.parametrize(("window", "reverse"), [(100, False), (500, True)])
def test_hurst_of_a_long_history(spark, window, reverse):
    """200,000 rows with a trend and a level: the last windows are as exact as the first."""
    import numpy as np
    import pandas as pd

    n = 200_000
    z = np.random.default_rng(9).normal(size=n) + 3.0
    df = spark.createDataFrame(pd.DataFrame({"ticker": "A", "at": np.arange(n) * 5 - 1000, "z": z}))
    got = fractal.hurst(df, window, reverse=reverse, time="at").where("at % 5000 = 0 or at > 998900 - 1000").toPandas().set_index("at")["hurst"]
    assert len(got) > 200 and got.index.max() == (n - 1) * 5 - 1000
    for at in [*got.index[::20], got.index.max()]:
        end = (at + 1000) // 5 + 1
        if end >= window:
            assert got[at] == pytest.approx(exponent(z[end - window : end], window, reverse), abs=2e-8)
        else:
            assert math.isnan(got[at])


@pytest.mark.parametrize("kind", ["timestamp_seconds(3600 * n)", "lpad(n, 4, '0')"])
def test_hurst_keys_of_other_types(spark, kind):
    df = spark.range(300).selectExpr("case when id < 150 then 'A' else 'B' end t", "id % 150 n", "sin(id * id) z").selectExpr("t", f"{kind} at", "n", "z")
    got = fractal.hurst(df, 100, key="t", time="at").orderBy("t", "n").collect()
    for a in (0, 150):
        z = [r["z"] for r in got[a : a + 150]]
        import numpy as np

        assert got[a + 98]["hurst"] is None and got[a + 149]["hurst"] == pytest.approx(exponent(np.array(z[50:150]), 100), abs=1e-9)


@pytest.mark.parametrize("reverse", [False, True])
def test_hurst_against_definition(bars, spark, reverse):
    import numpy as np

    rng = np.random.default_rng(1)
    z = rng.normal(size=230)
    df = spark.createDataFrame([("A", D(i), float(v)) for i, v in enumerate(z)], "ticker string, date date, z double")
    got = column(fractal.hurst(df, 100, reverse=reverse), "hurst")
    assert got[98] is None and all(v is not None for v in got[99:])
    for end in (99, 150, 229):
        profile = np.cumsum(z[end - 99 : end + 1] - z[end - 99 : end + 1].mean())
        xs, ys = [], []
        for s in fractal.SCALES[100]:
            ss = 0.0
            starts = [b * s for b in range(100 // s)] + [100 - (b + 1) * s for b in range(100 // s) if reverse]
            for a in starts:
                y = profile[a : a + s]
                x = np.arange(s)
                ss += ((y - np.polyval(np.polyfit(x, y, 1), x)) ** 2).sum()
            xs.append(math.log(s))
            ys.append(0.5 * math.log(ss / (len(starts) * s)))
        assert got[end] == pytest.approx(np.polyfit(xs, ys, 1)[0], abs=1e-9)
