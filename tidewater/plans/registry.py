"""Every registered query of the analytics and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.expr import col, finite, ieee_div, pct, ratio, round32, safe_div, rnd, rnd_column
from tidewater.operators import ewm, exports, fractal, indicators, insiders, panel, rank, snapshot, statements, tables, technical
from tidewater.plans import oracle as O
from tidewater.sources import datasets
from tidewater.sources.datasets import cut, passing, scratch
from tidewater.sources.fixtures import AS_OF, duck, view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DAY = ["ticker", "date"]
REPORT = ["ticker", "calendardate"]


def query(sql: str | None = None, *columns: str, name: str | None = None):
    """Register a query that returns ``columns``, 'name:digits' rounded; its SQL must end in FROM what it selects."""

    def add(f):
        key = name or f.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return pick(df, columns) if columns else df

        QUERIES[key] = run
        if sql:
            ORACLE[key] = sql.replace("{cols}", O.cols(*columns))
        return f

    return add


def pick(df: DataFrame, columns) -> DataFrame:
    out = []
    for item in columns:
        name, _, digits = item.partition(":")
        out.append(rnd_column(F.col(f"`{name}`").cast("double"), int(digits)).alias(name) if digits else F.col(f"`{name}`"))
    return df.select(*out)


def bars(spark, sf_dir):
    return indicators.adjust_prices(view(spark, sf_dir, "bars"))


def ttm(spark, sf_dir):
    return statements.financials_ttm(view(spark, sf_dir, "fin"))


def qtr(spark, sf_dir):
    return statements.financials_qtr(view(spark, sf_dir, "fin"), bars(spark, sf_dir))


def base(spark, sf_dir):
    co = view(spark, sf_dir, "co")
    prices, fin = cut(bars(spark, sf_dir), "bars"), cut(_FIN(spark, sf_dir), "fin")
    last = technical.technical_last(prices, snapshot.active_companies(co), written=True)
    return cut(snapshot.company_base(co, last, statements.financials_ttm(fin), statements.financials_qtr(fin, prices)), "companies")


def companies(spark, sf_dir):
    return snapshot.rank_companies(base(spark, sf_dir))


def from_tech(where: str = "tech") -> str:
    return O.DAILY + "SELECT {cols} FROM " + where


def simple(name: str, source, step, sql: str, *columns: str) -> None:
    query(sql, *columns, name=name)(lambda spark, sf_dir: step(source(spark, sf_dir)))


# --- sources and sinks -------------------------------------------------------

@query(f"SELECT {{cols}} FROM ({duck('bars')}) b", *DAY, "open:4", "high:4", "low:4", "close:4", "closeadj:4", "volume:4")
def src_csv_roundtrip(spark, sf_dir):
    """Bars written as CSV, staged to Parquet under an explicit schema and read back."""
    root = scratch(spark, "csv")
    view(spark, sf_dir, "bars").write.csv(f"{root}/csv", header=True)
    return datasets.stage_dataset(spark, f"{root}/csv", f"{root}/parquet", "stocks_prices")


@query(f"SELECT {{cols}} FROM ({duck('co')}) c WHERE isdelisted = 'N'", *snapshot.COMPANY)
def sink_table(spark, sf_dir):
    return datasets.save_table(snapshot.active_companies(view(spark, sf_dir, "co")), "tidewater_companies")


@query(f"SELECT {{cols}} FROM ({O.PX}) p", *DAY, "close:4")
def export_partitioned(spark, sf_dir):
    root = scratch(spark, "export")
    exports.export_partitioned(bars(spark, sf_dir).select("ticker", "date", "close"), root, ["date"], keep_key=True)
    return spark.read.parquet(root)


@query(r"SELECT DISTINCT regexp_replace(concat(s_name, '/', n_name), '[^A-Za-z0-9_.-]', '_', 'g') AS key FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def sanitize_key(spark, sf_dir):
    names = view(spark, sf_dir, "co").select(F.concat_ws("/", "name", "location").alias("k"))
    return names.select(exports.sanitize_key("k").alias("key")).distinct()


# --- scalar rules ------------------------------------------------------------

simple("adjusted_prices", bars, lambda d: d, f"SELECT {{cols}} FROM ({O.PX}) p", *DAY, "open:4", "high:4", "low:4", "close:4", "volume:2")


@query(
    f"SELECT ticker, calendardate, fcf / nullif(assets, 0) AS quotient, {O.pct('fcf', 'assets')} AS per_cent, {O.ratio('fcf', 'assets')} AS ratio3, CAST(CAST(round(fcf / nullif(assets, 0), 2) AS FLOAT) AS DOUBLE) AS narrow, "
    f"CASE WHEN assets = 0 THEN 'inf' ELSE 'finite' END AS kind FROM ({duck('fin')}) f".replace("fcf / nullif(assets, 0) AS quotient", "round(fcf / nullif(assets, 0), 6) AS quotient"),
)
def safe_div_pct(spark, sf_dir):
    q = safe_div("fcf", "assets")
    raw = ieee_div(col("fcf"), col("assets"))
    return view(spark, sf_dir, "fin").select(
        *REPORT, rnd(q, 6).alias("quotient"), pct(q).alias("per_cent"), ratio("fcf", "assets").alias("ratio3"),
        round32(q, 2).cast("double").alias("narrow"), F.when(finite(raw).isNull(), "inf").otherwise("finite").alias("kind"),
    )


_FIN = lambda spark, sf_dir: view(spark, sf_dir, "fin")
_ADJ = lambda spark, sf_dir: statements.adjust_financials(_FIN(spark, sf_dir))
simple("fx_normalise", _FIN, statements.fx_normalise, f"WITH {O.adjusted(True)} SELECT {{cols}} FROM n1", *REPORT, *[f"{c}:4" for c in datasets.MONEY])
simple("statement_ratios", _FIN, lambda d: statements.statement_ratios(statements.fx_normalise(d)), f"WITH {O.adjusted(True)} SELECT {{cols}} FROM n2", *REPORT, *[f"{c}:1" for c in datasets.RATIOS], "ebitmargin:1", "de:3", "sharesbas:2", "sharesdil:2")
simple("adjusted_eps", _FIN, statements.adjust_financials, f"WITH {O.adjusted(True)} SELECT {{cols}} FROM n3", *REPORT, "netincadj:2", "netdebt:2", "epsadj:2")
_TTM_SQL = f"WITH {O.TTM} SELECT {{cols}} FROM ttm"
_GROWTH = [f"{c}:1" for c in "revenueyoy revenue5y ebitda1y epsyoy fcfyoy".split()]
_CAGR = [f"{c}:1" for c in "dpscagr5y revenuecagr3y revenuecagr5y ebitdacagr3y ebitdacagr5y epscagr3y epscagr5y fcfcagr3y fcfcagr5y".split()]
_METRICS = [f"{c}:3" for c in "__q_ebitmargin_metric __q_revenuecagr5y_metric __q_salesassetscagr3y_metric __q_grossprofitassetscagr3y_metric __q_opprofitassetscagr3y_metric __q_rndintensity_metric __q_rndcagr3y_metric __q_cfc_metric __q_fcfassets_metric __q_cashaccruals_metric __q_icr_metric __q_cashassets_metric __q_gpassets_metric __q_intangiblesassets_metric".split()]
_LEVELS = ["ebitadj:2", "roce:1", "pretaxmargin:1", "bbyield:1"]
simple("ttm_levels", _ADJ, statements.ttm_levels, _TTM_SQL, *REPORT, *_LEVELS)
simple("fcf_adjusted", _ADJ, statements.fcf_adjusted, _TTM_SQL, *REPORT, "fcfadj:2", "fcfpsadj:2")
simple("quality_features", _ADJ, lambda d: statements.quality_features(statements.ttm_levels(d)), _TTM_SQL, *REPORT, *_METRICS)
simple("pct_change_yoy", _ADJ, lambda d: statements.ttm_growth(statements.fcf_adjusted(d)), _TTM_SQL, *REPORT, *_GROWTH)
simple("cagr", _ADJ, lambda d: statements.ttm_growth(statements.fcf_adjusted(statements.ttm_levels(d))), _TTM_SQL, *REPORT, *_CAGR)
simple("fs_score", _ADJ, statements.fs_score, _TTM_SQL, *REPORT, "fsscore")
_TTM_COLS = ["ticker", "calendardate", "reportperiod", "fiscalperiod", "revenue:4", "sharesdil:2", "netincadj:2", "netdebt:2", "epsadj:2", "de:3", "ebitdaps:4", "fcfadj:2", "fcfpsadj:2", "fsscore", *_LEVELS, *_GROWTH, *_CAGR, *_METRICS]
simple("financials_ttm", ttm, lambda d: d, _TTM_SQL, *_TTM_COLS)
_QTR_SQL = f"WITH {O.QTR} SELECT {{cols}} FROM qtr"
_ACCEL = ["revenueqtraccel:2", "epsqtr1qagoyoy:3", "epsqtr2qagoyoy:3", "epsqtraccel:3", "grossmarginqtrexp:2", "ebitdamarginqtrexp:2", "roicqtrexp:2"]
simple("eps_yield_delta", qtr, lambda d: d, _QTR_SQL, *REPORT, "epsqtrchg:3")
simple("qtr_acceleration", qtr, lambda d: d, _QTR_SQL, *REPORT, *_ACCEL)
simple("financials_qtr", qtr, lambda d: d, _QTR_SQL, *REPORT, "reportperiod", "revenue:4", "netincadj:2", "netdebt:4", "epsadj:2", "revenueqtryoy:1", "epsqtryoy:1", "epsqtrchg:3", *_ACCEL)


@query(f"WITH {O.QTR} SELECT ticker, calendardate, reportperiod, round(report_close, 4) AS report_close FROM q1")
def asof_report_close(spark, sf_dir):
    done = statements.join_report_closes(_FIN(spark, sf_dir), bars(spark, sf_dir))
    return done.select(*REPORT, "reportperiod", rnd(F.col("__report_close"), 4).alias("report_close"))


# --- price indicators --------------------------------------------------------

simple("sma", bars, indicators.sma, from_tech(), *DAY, *[f"sma{p}:4" for p in indicators.SMA_PERIODS])
simple("highlows", bars, indicators.highlows, from_tech(), *DAY, *[f"{k}{w}:4" for w in indicators.EXTREME_WINDOWS for k in ("min", "max")])
simple("rate_of_change", bars, indicators.rate_of_change, from_tech(), *DAY, *[f"pct{p}:2" for p in indicators.CHANGE_PERIODS])
simple("adr", bars, indicators.adr, from_tech(), *DAY, "adr:3")
simple("bollinger", bars, indicators.bollinger, from_tech(), *DAY, "bbtop:3", "bbbot:3")
simple("breakout_flags", bars, lambda d: indicators.breakout_flags(indicators.highlows(d)), from_tech(), *DAY, "high252", "low252")
simple("dollar_volume", bars, indicators.dollar_volume, from_tech(), *DAY, "volumeusd:2")
simple("volume_roc", bars, lambda d: indicators.volume_roc(indicators.volume_averages(indicators.dollar_volume(d))), from_tech(), *DAY, "avgvolume60:4", "avgvolumeusd20:2", "avgvolumeusd126:2", "volumeroc:4")
simple("ema", bars, ewm.ema, from_tech(), *DAY, "ema10:4", "ema20:4")
simple("atr", bars, ewm.atr, from_tech(), *DAY, "atr20:4")
simple("rsi", bars, ewm.rsi, from_tech(), *DAY, "rsi14:4")
simple("macd", bars, ewm.macd, from_tech(), *DAY, "macd:4", "macd_signal:4")


@query(O.DAILY + "SELECT ticker, date, round(rs, 3) AS rs_raw FROM tech")
def rs_raw(spark, sf_dir):
    return indicators.rs_raw(indicators.rate_of_change(bars(spark, sf_dir))).select(*DAY, rnd(F.col("__rs"), 3).alias("rs_raw"))


@query(O.DAILY + "SELECT ticker, date, round(ad0, 4) AS ad_raw FROM tech")
def ad_raw(spark, sf_dir):
    return indicators.close_location(indicators.volume_averages(indicators.dollar_volume(bars(spark, sf_dir)))).select(*DAY, rnd(F.col("__ad"), 4).alias("ad_raw"))


@query(O.DAILY + "SELECT ticker, date, round(ad, 4) AS ad FROM tech")
def ad_score(spark, sf_dir):
    return ewm.ewm(bars(spark, sf_dir), technical.accumulation_steps()).select(*DAY, rnd(F.col("ad"), 4).alias("ad"))


@query(O.DAILY + "SELECT ticker, date, round(volconfirm, 4) AS volconfirm FROM tech")
def volconfirm(spark, sf_dir):
    df = indicators.volume_roc(indicators.volume_averages(indicators.dollar_volume(indicators.rate_of_change(bars(spark, sf_dir)))))
    df = rank.percentile(rank.percentile(indicators.rs_raw(df), "__rs", "date", True, "rsrank"), "volumeroc", "date", True, "volumerocrank")
    return indicators.volume_confirmed(df).select(*DAY, rnd(F.col("__volconfirm"), 4).alias("volconfirm"))


_RET = f"WITH px AS ({O.PX}), r AS (SELECT *, ln(close / nullif(lag(close) OVER {O.T}, 0)) AS r, ln(open / nullif(lag(close) OVER {O.T}, 0)) AS ov, ln(close / nullif(open, 0)) AS oc, ln(high / nullif(close, 0)) * ln(high / nullif(open, 0)) + ln(low / nullif(close, 0)) * ln(low / nullif(open, 0)) AS rs, row_number() OVER {O.T} AS rn FROM px)"
query(f"{_RET} SELECT ticker, date, round({O.f32('(' + O.full('stddev_pop', 'r', 20) + ') * sqrt(252) * 100')}, 2) AS rv20 FROM r", *DAY, "rv20:2", name="realized_vol")(lambda spark, sf_dir: indicators.realized_volatility(bars(spark, sf_dir)))
_YZ = f"({O.full('var_samp', 'ov', 20)}) + {0.34 / (1 + 21 / 19)!r}e0 * ({O.full('var_samp', 'oc', 20)}) + {1 - 0.34 / (1 + 21 / 19)!r}e0 * ({O.full('avg', 'rs', 20)})"
query(f"{_RET}, y AS (SELECT *, ({_YZ}) * 252 AS yz_variance FROM r) SELECT ticker, date, round(yz_variance, 4) AS yz_variance, round(sqrt(yz_variance), 4) AS yz_vol FROM y", *DAY, "yz_variance:4", "yz_vol:4", name="yang_zhang")(lambda spark, sf_dir: indicators.yang_zhang(bars(spark, sf_dir)))
_EV = "pow(0.94e0, rn - 2) * sum(CASE WHEN rn = 2 THEN r * r WHEN rn > 2 THEN 0.06e0 * r * r * pow(0.94e0, 2 - rn) END) OVER (PARTITION BY ticker ORDER BY date)"
query(f"{_RET}, v AS (SELECT *, CASE WHEN rn > 1 THEN {_EV} * 252 END AS ewma_variance FROM r) SELECT ticker, date, round(ewma_variance, 4) AS ewma_variance, round(sqrt(ewma_variance), 4) AS ewma_vol FROM v", *DAY, "ewma_variance:4", "ewma_vol:4", name="ewma_vol")(lambda spark, sf_dir: ewm.ewma_vol(bars(spark, sf_dir)))
_ADX = f"""
{O.DAILY}, x0 AS (SELECT *, high - lag(high) OVER {O.T} AS um, lag(low) OVER {O.T} - low AS dm FROM tech),
x1 AS (SELECT *, CASE WHEN um > dm AND um > 0 THEN um ELSE 0 END AS pdm, CASE WHEN dm > um AND dm > 0 THEN dm ELSE 0 END AS mdm FROM x0),
x2 AS (SELECT *, {O.ewm("tr", "(rn - 1)", "1", "14", 14)} AS a, {O.ewm("pdm", "rn", "1", "14", 14)} AS p, {O.ewm("mdm", "rn", "1", "14", 14)} AS m FROM x1),
x3 AS (SELECT *, 100 * abs(100 * p / a - 100 * m / a) / nullif(100 * p / a + 100 * m / a, 0) AS dx FROM x2),
x4 AS (SELECT *, count(dx) OVER {O.T} AS ix FROM x3), x5 AS (SELECT ticker, date, {O.ewm("dx", "ix", "1", "14", 14)} AS adx14 FROM x4) SELECT {{cols}} FROM x5"""
query(_ADX, *DAY, "adx14:4", name="adx")(lambda spark, sf_dir: ewm.adx(bars(spark, sf_dir)))
query(O.hurst_sql(100).rpartition("h2 AS")[0].rstrip().rstrip(",") + " SELECT {cols} FROM sig", *DAY, "z:4", name="hurst_signal")(lambda spark, sf_dir: fractal.hurst_signal(bars(spark, sf_dir)))
_HURST = " SELECT ticker, date, round(CASE WHEN bool_and(ok) AND count(ly) >= 3 THEN regr_slope(ly, lx) END, 4) AS hurst FROM h4 GROUP BY ticker, date"
for _w in (100, 500):
    query(O.hurst_sql(_w) + _HURST, *DAY, "hurst:4", name="hurst" if _w == 100 else "hurst_500")(lambda spark, sf_dir, w=_w: fractal.hurst(fractal.hurst_signal(bars(spark, sf_dir)), w))

_TECH_COLS = [*DAY, "open:4", "high:4", "low:4", "close:4", "volume:2", "avgvolume60:4", "avgvolumeusd20:2", "avgvolumeusd126:2", *[f"{k}{w}:4" for w in (20, 55, 252) for k in ("min", "max")], "high252", "low252", "adr:3", "atr20:4", "bbbot:3", "bbtop:3",
              *[f"pct{p}:2" for p in indicators.CHANGE_PERIODS], "rs1y:2", "rsrank:2", "volumeroc:4", "volumerocrank:2", "volconfirmrank:2", "adrank:2", *[f"sma{p}:4" for p in indicators.SMA_PERIODS], "macd:4", "macd_signal:4", "rsi14:4"]
simple("technical_daily", bars, technical.technical_daily, from_tech(), *_TECH_COLS)
_WEEKLY_HURST = "SELECT {cols} FROM (" + O.WEEKLY + " SELECT * FROM tech) t LEFT JOIN (" + O.hurst_sql(100, O.resampled("week")) + _HURST + ") h USING (ticker, date)"
simple("technical_weekly", bars, technical.technical_weekly, _WEEKLY_HURST, *_TECH_COLS, "hurst:4")
simple("weekly_period_rank", bars, lambda d: technical.technical_weekly(d, None, rank_by="period"), O.WEEKLY_BY_PERIOD + "SELECT {cols} FROM tech", *DAY, "close:4", "rs1y:2", "rsrank:2", "volumerocrank:2", "volconfirmrank:2", "adrank:2")
_OHLCV = [*DAY, "open:4", "high:4", "low:4", "close:4", "volume:2"]
query(O.hurst_sql(100, O.resampled("week")) + _HURST, *DAY, "hurst:4", name="hurst_weekly")(lambda spark, sf_dir: technical.technical_weekly(bars(spark, sf_dir), hurst_window=100))
query(O.hurst_sql(100, reverse=True) + _HURST, *DAY, "hurst:4", name="hurst_reverse")(lambda spark, sf_dir: fractal.hurst(fractal.hurst_signal(bars(spark, sf_dir)), 100, reverse=True))
simple("resample_weekly", bars, lambda d: panel.resample_ohlcv(d, "week"), f"SELECT {{cols}} FROM ({O.resampled('week')}) r", *_OHLCV)
simple("resample_monthly", bars, lambda d: panel.resample_ohlcv(d, "month"), f"SELECT {{cols}} FROM ({O.resampled('month')}) r", *_OHLCV)
simple("latest_per_key", bars, lambda d: panel.latest_per_key(d, "date"), f"SELECT {{cols}} FROM ({O.PX}) p QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1", *_OHLCV)
simple("sort_panel", bars, lambda d: d.repartition("ticker").sortWithinPartitions(*DAY), f"SELECT {{cols}} FROM ({O.PX}) p ORDER BY ticker, date", *_OHLCV)


# --- ranks -------------------------------------------------------------------

@query(f"WITH px AS ({O.PX}), c AS (SELECT ticker, date, {O.f32(f'round((close / nullif(lag(close, 21) OVER {O.T}, 0) - 1) * 100, 2)')} AS pct21 FROM px) SELECT ticker, date, {O.percentile('pct21', 'date')} AS pctrank FROM c")
def percentile_by_date(spark, sf_dir):
    changed = indicators.rate_of_change(bars(spark, sf_dir), "close", (21,))
    return rank.percentile(changed, "pct21", "date", True, "pctrank").select(*DAY, rnd(F.col("pctrank").cast("double"), 2).alias("pctrank"))


@query(f"WITH s AS (SELECT s_suppkey, round(s_acctbal, 0) AS bal FROM supplier) SELECT s_suppkey, {O.percentile('bal', '', '100.0e0')} AS high_good, {O.percentile('bal', '', '100.0e0', 'DESC')} AS low_good FROM s")
def snapshot_percentile(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", rnd(F.col("s_acctbal"), 0).alias("bal"))
    done = rank.snapshot_percentiles(df, [("bal", True, "high_good"), ("bal", False, "low_good")], "s_suppkey")
    return pick(done, ["s_suppkey", "high_good:2", "low_good:2"])


_SPECS = [("roe", True, "roerank", True), ("netmargin", False, "marginplace", False)]
_BACK = f"{O.UNIVERSE} SELECT f.ticker, f.calendardate, f.reportperiod, {{what}} FROM ({duck('fin')}) f LEFT JOIN ranked r ON f.ticker = r.ticker AND f.reportperiod = r.reportperiod"


@query(_BACK.replace("{what}", "round(roerank, 2) AS roerank, round(marginplace, 2) AS marginplace"))
def period_rank(spark, sf_dir):
    return pick(rank.period_ranks(_FIN(spark, sf_dir), _SPECS), [*REPORT, "reportperiod", "roerank:2", "marginplace:2"])


@query(_BACK.replace("{what}", f"round({O._blend([('roerank', 0.6), ('marginplace', 0.4)], 0.5)}, 2) AS score"))
def weighted_period_rank(spark, sf_dir):
    done = rank.weighted_period_rank(_FIN(spark, sf_dir), _SPECS, [("roerank", 0.6), ("marginplace", 0.4)], "score", 0.5)
    return pick(done, [*REPORT, "reportperiod", "score:2"])


@query(O.UNIVERSE + "SELECT ticker, reportperiod FROM u")
def period_universe(spark, sf_dir):
    fin = _FIN(spark, sf_dir)
    return panel.period_universe(fin, fin, "reportperiod")


@query(O.UNIVERSE + "SELECT ticker, reportperiod, round(roe, 6) AS roe FROM known")
def asof_period_snapshot(spark, sf_dir):
    fin = _FIN(spark, sf_dir).select("ticker", "reportperiod", "roe")
    done = panel.asof_join(panel.period_universe(fin, fin, "reportperiod"), fin, "reportperiod", "ticker", 366, ["roe"])
    return pick(done, ["ticker", "reportperiod", "roe:6"])


_PARTS = [("roe", 0.5), ("rnd", 0.3), ("de", 0.2)]
for _name, _f, _neutral in (("weighted_score", rank.weighted_score, False), ("weighted_score_neutral", rank.weighted_score_neutral, True)):
    query(f"WITH {O.adjusted(True)} SELECT ticker, calendardate, round({O._blend(_PARTS, 0.75, _neutral)}, 1) AS score FROM n3", name=_name)(lambda spark, sf_dir, f=_f: pick(_ADJ(spark, sf_dir).withColumn("score", f(_PARTS, 0.75)), [*REPORT, "score:1"]))

_SNAP = O.SNAP + "SELECT {cols} FROM snap"


def ranked(name: str, step, *columns: str) -> None:
    query(_SNAP, "ticker", *columns, name=name)(lambda spark, sf_dir: step(base(spark, sf_dir)))


ranked("quality_rank", snapshot.quality_rank, "qualrank:2")
ranked("value_rank", snapshot.value_rank, "valuerank:2")
ranked("eps_smr_rank", snapshot.eps_smr_rank, "epsrank:2", "smrqrank:2")
ranked("growth_rank", snapshot.growth_rank, "growthrank:2")
ranked("industry_rank", snapshot.industry_rank, "industryrank:2", "highrank:2")
ranked("composite_rank", lambda d: snapshot.composite_rank(snapshot.industry_rank(snapshot.eps_smr_rank(d))), "comprank:2")
ranked("momentum_rank", lambda d: snapshot.momentum_rank(snapshot.growth_rank(d)), "momrank:2")
ranked("overall_score", snapshot.rank_companies, "rankscore:2")
ranked("snapshot_valuation", lambda d: d, "marketcap:2", "ev:2", "peg:1")
ranked("value_multiples", snapshot.value_multiples, "__v_evebitda:4", "__v_evsales:4", "__v_peg:4")
query(O.SNAP + "SELECT ticker, round(high_proximity, 4) AS high_proximity FROM snap", name="high_proximity")(lambda spark, sf_dir: snapshot.high_proximity(base(spark, sf_dir)).select("ticker", rnd(F.col("__high_proximity"), 4).alias("high_proximity")))
query(f"SELECT {{cols}} FROM ({duck('co')}) c WHERE isdelisted = 'N'", *snapshot.COMPANY, name="active_companies")(lambda spark, sf_dir: snapshot.active_companies(view(spark, sf_dir, "co")))
_RANKS = [f"{c}:2" for c in "qualrank valuerank epsrank smrqrank growthrank industryrank highrank momrank comprank rankscore rsrank adrank volconfirmrank".split()]
query(_SNAP, *snapshot.COMPANY, "date", "close:4", "calendardate", "revenue:2", "netdebt:2", "epsqtr:2", "marketcap:2", "ev:2", "peg:1", "fsscore", *_RANKS, name="company_snapshot")(companies)


# --- insiders and exports ----------------------------------------------------

_INS = lambda spark, sf_dir: view(spark, sf_dir, "ins")
_INS_COLS = ["ticker", "date", "issuername", "ownername", "transactioncode", "securityadcode", "securitytitle", "officertitle", "isofficer", "isdirector", "istenpercentowner", "transactionvalue:2", "transactionshares:2", "transactionpricepershare:4"]
simple("insiders", _INS, lambda d: insiders.insiders(d, AS_OF), O.INSIDERS + "SELECT {cols} FROM insiders", *_INS_COLS)
simple("insider_daily", _INS, lambda d: insiders.insider_daily(insiders.insider_recent(d, AS_OF)), O.INSIDERS + "SELECT {cols} FROM daily", *_INS_COLS)
simple("insider_recent", _INS, lambda d: insiders.insider_recent(d, AS_OF), O.INSIDERS + "SELECT {cols} FROM recent", "ticker", "date", "ownername", "transactioncode", "isofficer", "transactionvalue:2")
simple("insider_titles", _INS, lambda d: insiders.insider_titles(insiders.insider_daily(insiders.insider_recent(d, AS_OF))), O.INSIDERS + "SELECT {cols} FROM insiders", "ticker", "date", "ownername", "officertitle", "isofficer", "isdirector", "istenpercentowner")
_SCREEN = f"{O.INSIDERS}, q AS (SELECT DISTINCT ticker FROM insiders WHERE date >= CAST(DATE '{AS_OF}' - INTERVAL 3 MONTH AS DATE) AND transactioncode = 'P' AND transactionvalue > 100000)"
_CODES = "(transactioncode IS NULL OR transactioncode NOT IN ('M', 'A', 'D', 'J', 'G', 'C'))"
simple("export_insiders", _INS, lambda d: exports.insider_screen(insiders.insiders(d, AS_OF), AS_OF), f"{_SCREEN} SELECT {{cols}} FROM insiders WHERE ticker IN (SELECT ticker FROM q) AND date >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE) AND {_CODES}", *_INS_COLS)
query(f"{_SCREEN} SELECT ticker, count(*) AS transactions FROM insiders WHERE ticker IN (SELECT ticker FROM q) AND date >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE) AND {_CODES} GROUP BY ticker", name="insider_cluster_buys")(lambda spark, sf_dir: exports.insider_screen(insiders.insiders(_INS(spark, sf_dir), AS_OF), AS_OF).groupBy("ticker").agg(F.count("*").alias("transactions")))


_HELD = f"ticker IN (SELECT ticker FROM ({duck('co')}) c WHERE isdelisted = 'N')"
_KEY = "regexp_replace(ticker, '[^A-Za-z0-9_.-]', '_', 'g') AS key"


def _back(spark, sf_dir, df, order, columns, keep_key=False):
    """``df`` of the active companies, written as files by ticker and read back with their folder as ``key``."""
    root = scratch(spark, "files")
    held = exports.of_companies(df, snapshot.active_companies(view(spark, sf_dir, "co")))
    exports.export_partitioned(held, root, order, keep_key=keep_key)
    names = [f.name for f in df.schema.fields if keep_key or f.name != "ticker"]
    schema = ", ".join([*(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names), "key string"])
    return pick(spark.read.schema(schema).parquet(root), ["key", *columns])


_INS_FILE = [c for c in _INS_COLS if c != "ticker"]


@query(f"{O.INSIDERS} SELECT {O.cols(*_INS_FILE)}, {_KEY} FROM insiders WHERE {_CODES} AND {_HELD}")
def export_insiders_by_key(spark, sf_dir):
    rows = exports.no_other_codes(insiders.insiders(_INS(spark, sf_dir), AS_OF))
    return _back(spark, sf_dir, rows, list(exports.INSIDER_ORDER), _INS_FILE)


@query(f"SELECT date, round(close, 4) AS close, {_KEY} FROM ({O.PX}) p WHERE {_HELD}")
def export_prices(spark, sf_dir):
    return _back(spark, sf_dir, bars(spark, sf_dir).select(*DAY, "close"), ["date"], ["date", "close:4"])


_LAST20 = "QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY calendardate DESC) <= 20"
_TTM_FILE = ["calendardate", "fiscalperiod", "fcf:2", "netdebt:2", "de:3", "roic:1", "roe:1", "grossmargin:1", "netmargin:1"]


@query(f"WITH {O.TTM} SELECT {O.cols(*_TTM_FILE)}, {_KEY} FROM ttm WHERE {_HELD} {_LAST20}")
def export_ttm_files(spark, sf_dir):
    return _back(spark, sf_dir, exports.last_reports(ttm(spark, sf_dir), ["calendardate", *exports.TTM_SERIES]), ["calendardate"], _TTM_FILE)


@query(f"WITH {O.QTR} SELECT calendardate, fiscalperiod, round(revenue, 2) AS revenue, round(netincadj, 2) AS netinc, {_KEY} FROM qtr WHERE {_HELD} {_LAST20}")
def export_qtr_files(spark, sf_dir):
    rows = exports.last_reports(qtr(spark, sf_dir).withColumn("netinc", F.col("netincadj")), ["calendardate", *exports.QTR_SERIES])
    return _back(spark, sf_dir, rows, ["calendardate"], ["calendardate", "fiscalperiod", "revenue:2", "netinc:2"])


def written(step):
    """The companies table after ``step``, written as one dataset and read back."""

    def run(spark, sf_dir):
        path = scratch(spark, "table")
        exports.export_table(step(companies(spark, sf_dir)), path)
        return spark.read.parquet(path)

    return run


_TWO = dict.fromkeys("qualrank rsrank growthrank momrank valuerank rankscore pct1d pct1w pct1m pct3m pct6m pct12m divyield eps volume".split(), 2)
_SCREEN_DIGITS = {"close": 4, "atr": 4, "rsi": 4} | _TWO
_TEXT = {"ticker", "name", "exchange", "sector", "industry", "revenuetrend", "epstrend"}
_SCREEN_COLS = [n if n in _TEXT else f"{n}:{_SCREEN_DIGITS.get(n, 1)}" for n, _ in exports.SCREEN]
query(f"{O.SNAP}, screen AS (SELECT {O.SCREEN} FROM snap) SELECT {{cols}} FROM screen", *_SCREEN_COLS, name="export_companies")(written(exports.companies_screen))
query(O.SNAP + "SELECT exchange, ticker, name, round(close, 4) AS close, round(pct1, 2) AS pct1d FROM snap", "exchange", "ticker", "name", "close:4", "pct1d:2", name="export_search")(written(exports.search_list))
_METRIC_COLS = [n if n in _TEXT else f"{n}:{_SCREEN_DIGITS.get(n, 1)}" for n, _ in exports.METRICS]
query(f"{O.SNAP}, m AS (SELECT {O.METRICS} FROM snap) SELECT {O.cols(*_METRIC_COLS)}, {_KEY} FROM m", name="export_metrics")(lambda spark, sf_dir: _back(spark, sf_dir, exports.company_metrics(companies(spark, sf_dir)), ["ticker"], _METRIC_COLS, keep_key=True))
simple("last20_ttm", ttm, lambda d: exports.last_reports(d, ["calendardate", *exports.TTM_SERIES]), f"WITH {O.TTM} SELECT {{cols}} FROM ttm QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY calendardate DESC) <= 20", *REPORT, "fiscalperiod", "fcf:2", "netdebt:2", "de:3", "roic:1", "roe:1", "grossmargin:1", "netmargin:1")
simple("last20_qtr", qtr, lambda d: exports.last_reports(d.withColumn("netinc", F.col("netincadj")), ["calendardate", "fiscalperiod", "revenue", "netinc"]), f"WITH {O.QTR} SELECT ticker, calendardate, fiscalperiod, round(revenue, 2) AS revenue, round(netincadj, 2) AS netinc FROM qtr QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY calendardate DESC) <= 20", *REPORT, "fiscalperiod", "revenue:2", "netinc:2")


# --- tables ------------------------------------------------------------------

def build(spark, sf_dir, *names, **options):
    """The named tables, written under names of the query's own, and those they need."""
    names = names or tuple(tables.NEEDS)
    with passing(spark):
        source = {"stocks_prices": cut(view(spark, sf_dir, "bars"), "bars"), "companies": view(spark, sf_dir, "co"), "insiders": view(spark, sf_dir, "ins")}
        if tables.made_for(names) & {"financials_ttm", "financials_qtr"}:
            source |= dict.fromkeys(("financials_ttm", "financials_qtr"), cut(_FIN(spark, sf_dir), "fin"))
        return tables.build_tables(source, AS_OF, names, prefix="tidewater_", **options)


_DAILY_HURST = "SELECT {cols} FROM (" + O.DAILY + " SELECT * FROM tech) t LEFT JOIN (" + O.hurst_sql(500) + _HURST + ") h USING (ticker, date)"


@query(_DAILY_HURST, *_TECH_COLS, "hurst:4")
def build_stock_prices(spark, sf_dir):
    """The daily table as written, with the exponent over 500 days."""
    return build(spark, sf_dir, "stock_prices")["stock_prices"]


@query(_WEEKLY_HURST, *_TECH_COLS, "hurst:4")
def build_weekly_prices(spark, sf_dir):
    return build(spark, sf_dir, "stock_prices_weekly")["stock_prices_weekly"]


@query(O.DAILY + "SELECT {cols} FROM tech", *_TECH_COLS)
def build_appended_prices(spark, sf_dir):
    """The daily table from a first part of the dates and two later ones, each added from the stored state."""
    parts = ["date < '1995-06-01'", "date >= '1995-06-01' and date < '1998-08-01'", "date >= '1998-08-01'"]
    with passing(spark):
        all_bars = cut(bars(spark, sf_dir), "bars")
        tables.start_prices(all_bars.where(parts[0]), "tidewater_parts_", written=True)
        for part in parts[1:]:
            done = tables.append_prices(spark, all_bars.where(part), "tidewater_parts_", written=True)
        return done


_SIZES = {
    "stock_prices": (f"({O.PX}) p", "date", "close"), "stock_prices_weekly": (f"({O.resampled('week')}) p", "date", "close"), "financials_ttm": (f"(WITH {O.TTM} SELECT * FROM ttm) t", "calendardate", "revenue"),
    "financials_qtr": (f"(WITH {O.QTR} SELECT * FROM qtr) q", "calendardate", "epsqtrchg"), "companies": (f"({O.SNAP} SELECT * FROM snap) s", "calendardate", "rankscore"), "insiders": (f"({O.INSIDERS} SELECT * FROM insiders) i", "date", "transactionvalue"),
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows, count(DISTINCT ticker) AS tickers, CAST(max({at}) AS DATE) AS last, count({c}) AS n_values, round(sum({c}), 1) AS total FROM {sql}" for n, (sql, at, c) in _SIZES.items()))
def build_all_tables(spark, sf_dir):
    """Rows, tickers, newest date and one column's sum of each of the six tables of one build."""
    made, out = build(spark, sf_dir, hurst=False), None
    for name, (_, at, c) in _SIZES.items():
        one = made[name].agg(F.count("*").alias("n_rows"), F.countDistinct("ticker").alias("tickers"), F.max(at).cast("date").alias("last"), F.count(c).alias("n_values"), rnd(F.sum(F.col(c).cast("double")), 1).alias("total")).select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionAll(one)
    return out


_SNAP_PRICE = ["date", "open:4", "high:4", "low:4", "close:4", "volume:2", "avgvolume60:4", "avgvolumeusd20:2", "adr:3", "atr20:4", "bbbot:3", "bbtop:3", *[f"pct{p}:2" for p in indicators.CHANGE_PERIODS], "volumeroc:4", *[f"sma{p}:4" for p in indicators.SMA_PERIODS], "macd:4", "macd_signal:4", "rsi14:4", "max252:4", "min252:4", "high252", "low252"]
_SNAP_FIN = ["calendardate", "reportperiod", "revenue:2", "netinc:2", "ebitda:2", "fcf:2", "assets:2", "debt:2", "equity:2", "cashneq:2", *[f"{c}:1" for c in datasets.RATIOS if c != "divyield"], "netincadj:2", "epsadj:2", "fcfadj:2", "fcfpsadj:2", "de:3", "fsscore", *_LEVELS, *_GROWTH, *_CAGR]
_SNAP_QTR = ["revenueqtryoy:1", "netmarginqtr:1", "epsqtr:2", "epsqtryoy:1", "epsqtrchg:3", *_ACCEL]


@query(_SNAP, *snapshot.COMPANY, *_SNAP_PRICE, *_SNAP_FIN, *_SNAP_QTR, *_RANKS)
def build_companies(spark, sf_dir):
    """The companies table as written from the tables that it needs, with its price, statement and quarter columns."""
    return build(spark, sf_dir, "companies", hurst=False)["companies"]


def _half_up(sql: str) -> str:
    """``round`` as Spark does it, on decimals with ties away from zero."""
    at = len(sql)
    while (at := sql.rfind("round(", 0, at)) >= 0:
        if at and (sql[at - 1].isalnum() or sql[at - 1] == "_"):
            continue
        depth, k, comma = 0, at + 6, None
        while depth >= 0:
            depth += (sql[k] == "(") - (sql[k] == ")")
            if sql[k] == "," and depth == 0:
                comma = k
            k += 1
        value, digits = sql[at + 6 : comma], sql[comma + 1 : k - 1].strip()
        sql = f"{sql[:at]}CAST(ROUND(TRY_CAST(({value}) * 1.0000000000001e0 AS DECIMAL(38, 12)), {digits}) AS DOUBLE){sql[k:]}"
    return sql


ORACLE = {k: _half_up(v) for k, v in ORACLE.items() if v}
