"""Curated exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.expr import NUDGE

OTHER_CODES = ("M", "A", "D", "J", "G", "C")  # fixed values

def _over(n: str, d: str, digits: int) -> str:
    """A rounded quotient, null on a zero divisor."""
    return f"round(try_divide({n}, {d}) * {NUDGE}e0, {digits})"


# fixed values: output column, expression of the companies screen and of the metrics
SCREEN = [
    *[(c, c) for c in ("ticker", "name", "exchange", "close")], ("pct1d", "pct1"), *[(c, c) for c in ("volume", "sharesdil", "marketcap", "sector", "industry")],
    ("avgvolumeusd1m", "avgvolumeusd20"), *[(c, c) for c in ("revenue", "revenueqtryoy", "revenueyoy", "revenuecagr3y", "revenue5y", "ev", "ebitda", "ebit", "debt")],
    ("cash", "cashneq"), ("netinc", "netinc"), ("epsqtr", "epsqtr"), ("evebitda", _over("ev", "ebitda", 1)), ("evsales", _over("ev", "revenue", 1)),
    ("pb", _over("marketcap", "equity", 1)), ("eps", _over("netinc", "sharesdil", 2)), ("pe", _over("marketcap", "netinc", 1)), ("fwdpe", _over("marketcap", "netinc * epsyoy / 100", 1)),
    *[(c, c) for c in ("epsyoy", "epscagr3y", "epsqtryoy", "fcf", "fcfyoy", "fcfcagr3y")], ("ps", _over("marketcap", "revenue", 1)), ("pfcf", _over("marketcap", "fcf", 1)),
    ("peg", _over("try_divide(ev, netinc)", "least(epscagr3y, revenuecagr3y, epsyoy, revenueyoy) + coalesce(try_divide(100 * dps, close), 0)", 1)),
    ("dps", "dps"), ("dpscagr5y", "dpscagr5y"), ("divyield", _over("100 * dps", "close", 2)), ("divpayoutratio", _over("100 * dps", _over("netinc", "sharesdil", 2), 1)),
    *[(c, c) for c in ("roa", "roe", "roic", "de", "grossmargin", "ebitdamargin", "netmargin")], ("pct1w", "pct5"), ("pct1m", "pct21"), ("pct3m", "pct63"), ("pct6m", "pct126"), ("pct12m", "pct252"),
    ("atr", "atr20"), ("rsi", "rsi14"), *[(c, c) for c in ("sma20", "sma50", "sma200", "max252", "min252", "qualrank", "rsrank", "growthrank", "momrank", "valuerank", "rankscore")],
    ("revenuetrend", "revenueqtraccel > 0"), ("epstrend", "epsqtraccel > 0 and epsqtr1qagoyoy > epsqtr2qagoyoy"),
]
METRICS = [(c, c) for c in "ticker name exchange marketcap netdebt netinc fcf close".split()] + [("pct1d", "pct1"), ("max1y", "max252"), ("low1y", "min252")] + [(c, c) for c in "rankscore qualrank growthrank momrank valuerank revenueyoy revenuecagr3y epsyoy epscagr3y grossmargin netmargin de roe roic dps".split()]


def _select(df: DataFrame, items) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in items])


def companies_screen(companies: DataFrame) -> DataFrame:
    return _select(companies, SCREEN)


def search_list(companies: DataFrame) -> DataFrame:
    return _select(companies, [("exchange", "exchange"), ("ticker", "ticker"), ("name", "name"), ("close", "close"), ("pct1d", "pct1")])


def company_metrics(companies: DataFrame) -> DataFrame:
    return _select(companies, METRICS)


def no_other_codes(df: DataFrame) -> DataFrame:
    return df.where(F.col("transactioncode").isNull() | ~F.col("transactioncode").isin(*OTHER_CODES))


def insider_screen(insiders: DataFrame, as_of: str) -> DataFrame:
    """Half a year of transactions of the tickers with a large purchase in the last three months."""
    day = F.lit(as_of).cast("date")
    buys = insiders.where((F.col("date") >= F.add_months(day, -3)) & (F.col("transactioncode") == "P") & (F.col("transactionvalue") > 100_000)).select("ticker")
    recent = no_other_codes(insiders.where(F.col("date") >= F.add_months(day, -6)))
    return recent.join(buys, "ticker", "left_semi").orderBy(F.desc("date"), F.desc("transactionvalue"), "ticker")


def last_reports(df: DataFrame, columns: list, n: int = 20) -> DataFrame:
    """The last ``n`` reports of each ticker, oldest first within it."""
    w = Window.partitionBy("ticker").orderBy(F.desc("calendardate"))
    top = df.select("ticker", *columns).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")
    return top.sortWithinPartitions("ticker", "calendardate")


def sanitize_key(column: str):
    """Characters that are not safe in file names become underscores."""
    return F.regexp_replace(column, "[^A-Za-z0-9_.-]", "_")


def of_companies(df: DataFrame, companies: DataFrame) -> DataFrame:
    """The rows of the tickers that are in ``companies``."""
    return df.join(companies.select("ticker").where("ticker is not null"), "ticker", "left_semi")


INSIDER_ORDER = (F.desc, "date"), (F.desc, "transactionvalue")


def export_table(df: DataFrame, path: str, *order) -> None:
    """One dataset of Parquet files, in order where one is given."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").parquet(path)


def export_partitioned(df: DataFrame, path: str, order: list, key: str = "ticker", keep_key: bool = False) -> None:
    """One folder per key, rows in order (names, or (direction, name) pairs), in one job.

    Rows are dealt by ranges of key and order: small keys share a task, a large one
    is several files whose numbers follow its order.  The folder's name is the sanitised key; keys that become equal share a folder, so
    ``keep_key`` leaves the key itself among the columns for readers who must tell them apart.
    """
    by = [o if isinstance(o, str) else o[0](o[1]) for o in order]
    keyed = df.withColumn("key", sanitize_key(key))
    sorted_ = keyed.repartitionByRange("key", *by).sortWithinPartitions("key", *by)
    (sorted_ if keep_key else sorted_.drop(key)).write.mode("overwrite").partitionBy("key").parquet(path)


def export_files(root: str, companies: DataFrame, prices: DataFrame, ttm: DataFrame, qtr: DataFrame, insiders: DataFrame, as_of: str) -> None:
    """The three tables and the five sets of files by ticker, below ``root``."""
    export_table(companies_screen(companies), f"{root}/companies")
    export_table(search_list(companies), f"{root}/search")
    export_table(insider_screen(insiders, as_of), f"{root}/insiders")
    for name, (df, order, keep) in ticker_files(companies, prices, ttm, qtr, insiders).items():
        export_partitioned(of_companies(df, companies), f"{root}/{name}", order, keep_key=keep)


def ticker_files(companies: DataFrame, prices: DataFrame, ttm: DataFrame, qtr: DataFrame, insiders: DataFrame) -> dict:
    """Rows, their order within a ticker, and whether the ticker stays a column, of each set of files."""
    return {
        "metrics_by_ticker": (company_metrics(companies), ["ticker"], True),
        "ttm_by_ticker": (last_reports(ttm, ["calendardate", *TTM_SERIES]), ["calendardate"], False),
        "qtr_by_ticker": (last_reports(qtr.withColumn("netinc", F.col("netincadj")), ["calendardate", *QTR_SERIES]), ["calendardate"], False),
        "insiders_by_ticker": (no_other_codes(insiders), list(INSIDER_ORDER), False),
        "prices_by_ticker": (prices.select("ticker", "date", "close"), ["date"], False),
    }


TTM_SERIES = "fiscalperiod fcf netdebt de roic roe grossmargin netmargin".split()
QTR_SERIES = "fiscalperiod revenue netinc".split()
