"""Financial statements: normalisation, levels, growth, F-score, quarterly signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import col, finite, nonzero, pct, ratio, safe_div, rnd
from tidewater.operators import panel
from tidewater.operators.panel import asof_join
from tidewater.sources.datasets import DROPPED, MONEY, RATIOS

TIME = "calendardate"


def lag(x: Column, n: int) -> Column:
    return panel.lag(x, n, time=TIME)


def fx_normalise(df: DataFrame) -> DataFrame:
    """Money columns over the exchange rate."""
    return df.withColumns({c: safe_div(c, "fxusd") for c in MONEY if c in df.columns})


def statement_ratios(df: DataFrame, ttm: bool = True) -> DataFrame:
    more = {"ebitmargin": pct(safe_div("ebit", "revenue")), "de": ratio("debt", "equity")} if ttm else {}
    shares = {"sharesbas": col("sharesbas") * col("sharefactor"), "sharesdil": col("shareswadil") * col("sharefactor")}
    return df.withColumns({c: pct(col(c)) for c in RATIOS} | more | shares)


def adjusted_eps(df: DataFrame, ttm: bool = True) -> DataFrame:
    debt = col("debt") - col("cashneq")
    step = df.withColumns({"netincadj": rnd(col("netinccmn") - col("netincdis"), 2), "netdebt": rnd(debt, 2) if ttm else debt})
    return step.withColumn("epsadj", rnd(safe_div("netincadj", "sharesdil"), 2))


def adjust_financials(df: DataFrame, ttm: bool = True) -> DataFrame:
    return adjusted_eps(statement_ratios(fx_normalise(df), ttm), ttm).drop(*DROPPED)


def pct_change(x: Column, n: int) -> Column:
    """Per cent change over ``n`` rows against the size of the earlier value."""
    before = lag(x, n)
    return rnd(finite(F.try_divide(x - before, F.abs(before)) * 100), 1)


def cagr(x: Column, years: int) -> Column:
    """Yearly growth over 4 * years rows; both ends must be positive."""
    before = lag(x, 4 * years)
    growth = F.pow(F.when((x > 0) & (before > 0), F.try_divide(x, before)), F.lit(1.0 / years)) - 1
    return rnd(finite(growth * 100), 1)


def ttm_levels(df: DataFrame) -> DataFrame:
    step = df.withColumn("ebitadj", rnd(col("ebit") - col("netincdis"), 2))
    return step.withColumns({
        "roce": pct(safe_div(col("ebitadj"), col("assets") - col("liabilitiesc"))), "pretaxmargin": pct(safe_div("ebt", "revenue")),
        "bbyield": pct(safe_div(-1.0 * col("ncfcommon"), col("marketcap"))), "dpscagr5y": cagr(col("dps"), 5),
    })


def fcf_adjusted(df: DataFrame) -> DataFrame:
    working = col("workingcapital")
    step = df.withColumn("__fcf", finite(col("ncfo") - col("netincdis") - (col("depamor") + col("sbcomp")) - (working - lag(working, 1))))
    return step.withColumns({"fcfadj": rnd(F.col("__fcf"), 2), "fcfpsadj": rnd(safe_div(F.col("__fcf"), col("sharesdil")), 2)}).drop("__fcf")


def ttm_growth(df: DataFrame) -> DataFrame:
    step = df.withColumn("ebitdaps", safe_div("ebitda", "sharesdil"))
    sps, ebitda, eps, fcf = (col(c) for c in ("sps", "ebitdaps", "epsadj", "fcfpsadj"))
    return step.withColumns({
        "revenueyoy": pct_change(sps, 4), "revenue5y": pct_change(sps, 20), "revenuecagr3y": cagr(sps, 3), "revenuecagr5y": cagr(sps, 5),
        "ebitda1y": pct_change(ebitda, 4), "ebitdacagr3y": cagr(ebitda, 3), "ebitdacagr5y": cagr(ebitda, 5),
        "epsyoy": pct_change(eps, 4), "epscagr3y": cagr(eps, 3), "epscagr5y": cagr(eps, 5),
        "fcfyoy": pct_change(fcf, 4), "fcfcagr3y": cagr(fcf, 3), "fcfcagr5y": cagr(fcf, 5),
    })


def fs_score(df: DataFrame, roa_scale: float = 1.0) -> DataFrame:
    """Ten yes-or-no tests against four rows earlier; an unknown test is no.

    ``roa`` is in per cent and cash return a fraction; ``roa_scale`` 0.01 makes the
    accruals test compare like with like.
    """
    before = lambda c: lag(col(c), 4)
    cash = F.try_divide(col("fcf"), nonzero("assets"))
    cash_before = F.try_divide(before("fcf"), nonzero(before("assets")))
    tests = [
        col("roa") > 0, cash > 0, cash > col("roa") * roa_scale, col("de") < before("de"), col("currentratio") > before("currentratio"),
        col("shareswadil") <= before("shareswadil"), col("roa") > before("roa"), cash > cash_before,
        col("grossmargin") > before("grossmargin"), col("assetturnover") > before("assetturnover"),
    ]
    points = [F.coalesce(t, F.lit(False)).cast("int") for t in tests]
    return df.withColumn("fsscore", sum(points[1:], points[0]))


def quality_features(df: DataFrame) -> DataFrame:
    assets = nonzero("assets")
    return df.withColumns({
        "__q_ebitmargin_metric": pct(safe_div("ebitadj", "revenue")), "__q_revenuecagr5y_metric": cagr(col("sps"), 5),
        "__q_salesassetscagr3y_metric": cagr(col("assetturnover"), 3), "__q_grossprofitassetscagr3y_metric": cagr(safe_div(col("gp"), assets), 3),
        "__q_opprofitassetscagr3y_metric": cagr(safe_div(col("opinc"), assets), 3), "__q_rndintensity_metric": pct(safe_div(col("rnd"), nonzero("revenue"))),
        "__q_rndcagr3y_metric": cagr(col("rnd"), 3), "__q_cfc_metric": ratio("ncfo", "opinc"), "__q_fcfassets_metric": ratio(col("fcf"), assets),
        "__q_cashaccruals_metric": ratio(col("ncfo") - col("ebitadj"), assets), "__q_icr_metric": ratio("ebitadj", "intexp"),
        "__q_cashassets_metric": ratio(col("cashneq"), assets), "__q_gpassets_metric": ratio(col("gp"), assets), "__q_intangiblesassets_metric": ratio(col("intangibles"), assets),
    })


def financials_ttm(df: DataFrame) -> DataFrame:
    return quality_features(fs_score(ttm_growth(fcf_adjusted(ttm_levels(adjust_financials(df, ttm=True))))))


def eps_yield_delta(eps: Column, close: Column) -> Column:
    """Change of earnings over four rows, in per cent of the price."""
    return rnd(F.when(close > 0, finite(F.try_divide(eps - lag(eps, 4), close) * 100)), 3)


def join_report_closes(df: DataFrame, closes: DataFrame, tolerance_days: int = 10) -> DataFrame:
    prices = closes.select("ticker", F.to_date("date").alias("reportperiod"), col("close").alias("__report_close"))
    return asof_join(df, prices, "reportperiod", "ticker", tolerance_days, ["__report_close"])


def qtr_growth(df: DataFrame) -> DataFrame:
    return df.withColumns({"revenueqtryoy": pct_change(col("sps"), 4), "epsqtryoy": pct_change(col("epsadj"), 4), "epsqtrchg": eps_yield_delta(col("epsadj"), col("__report_close"))})


def qtr_acceleration(df: DataFrame) -> DataFrame:
    x = col("epsqtrchg")
    more = lambda c, n: col(c) - lag(col(c), n)
    return df.withColumns({
        "revenueqtraccel": more("revenueqtryoy", 1), "epsqtr1qagoyoy": lag(x, 1), "epsqtr2qagoyoy": lag(x, 2), "epsqtraccel": (x - lag(x, 2)) / 2,
        "grossmarginqtrexp": more("grossmargin", 4), "ebitdamarginqtrexp": more("ebitdamargin", 4), "roicqtrexp": more("roic", 4),
    })


def financials_qtr(df: DataFrame, closes: DataFrame) -> DataFrame:
    return qtr_acceleration(qtr_growth(join_report_closes(adjust_financials(df, ttm=False), closes))).drop("__report_close")
