"""Views over the test tables in the shape of the input datasets.

The text of each view runs in Spark and in DuckDB; ``{lineitem}`` and the like
stand for the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.datasets import BALANCE, CASH_FLOW, INCOME, MONEY, RATIOS

AS_OF = "2001-08-01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

BARS = """
SELECT ticker, date,
       max(CASE WHEN first = 1 THEN px END) * k AS open, max(hi) * k AS high, min(lo) * k AS low,
       max(CASE WHEN last = 1 THEN px END) * k AS close, max(CASE WHEN last = 1 THEN px END) AS closeadj, sum(qty) AS volume
FROM (SELECT *, CASE WHEN date < DATE '1998-01-01' THEN 2.0e0 ELSE 1.0e0 END AS k,
             row_number() OVER (PARTITION BY ticker, date ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS first,
             row_number() OVER (PARTITION BY ticker, date ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) AS last
      FROM (SELECT CAST(l_suppkey AS STRING) AS ticker, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
                   l_quantity AS qty, l_extendedprice / l_quantity AS px,
                   l_extendedprice / l_quantity * (1 + l_discount) AS hi, l_extendedprice / l_quantity * (1 - l_tax) AS lo
            FROM {lineitem}) x) y
GROUP BY ticker, date, k"""

# fixed values: each statement column from quarter sums R revenue, C cost, D discounts, T taxes, Q units, N lines and the balance A
_FORMULAS = {
    "revenue": "R", "cor": "C", "gp": "R - C", "sgna": "R * 0.05e0", "rnd": "CASE WHEN s % 13 = 0 THEN NULL ELSE N * 50.0e0 + Q END", "opex": "R * 0.05e0 + N * 50.0e0",
    "intexp": "A * 0.5e0", "taxexp": "T", "netincdis": "0.0e0", "consolinc": "R - C - D - T", "netincnci": "0.0e0", "netinc": "R - C - D - T", "prefdivis": "0.0e0",
    "netinccmn": "R - C - D - T", "eps": "(R - C - D - T) / Q", "epsdil": "(R - C - D - T) / (Q + 10)", "ebt": "R - C - D", "ebit": "R - C - D + A * 0.5e0",
    "ebitda": "R - C - D + A * 0.5e0 + N * 20", "opinc": "R - C - R * 0.05e0", "capex": "N * -30.0e0", "ncfbus": "0.0e0", "ncfinv": "D * -0.1e0", "ncff": "D * 0.2e0",
    "ncfdebt": "A * 0.1e0", "ncfcommon": "N * -10.0e0 + Q", "ncfdiv": "T * -0.1e0", "ncfi": "N * -40.0e0", "ncfo": "R - C - D * 0.5e0", "ncfx": "0.0e0", "ncf": "R * 0.01e0",
    "sbcomp": "N * 5.0e0", "depamor": "N * 20.0e0", "fcf": "R - C - D * 0.5e0 - N * 30.0e0", "cashneq": "R * 0.1e0", "receivables": "R * 0.2e0", "payables": "C * 0.3e0",
    "inventory": "Q * 10.0e0", "intangibles": "A * 2.0e0", "liabilities": "A * 200.0e0 + C", "equity": "R * 3 + A * 700.0e0", "retearn": "R - C", "assetsc": "R * 0.6e0 + A",
    "liabilitiesc": "C * 0.4e0", "debt": "A * 100.0e0", "debtc": "A * 30.0e0", "debtnc": "A * 70.0e0", "invcap": "R * 2 + A * 100.0e0", "workingcapital": "R * 0.6e0 + A - C * 0.4e0",
    "assets": "CASE WHEN s % 17 = 0 THEN 0.0e0 ELSE R * 4 + A * 1000.0e0 END", "tangibles": "R * 4 + A * 998.0e0", "fcfps": "(R - C) / Q", "bvps": "(R * 3) / Q", "tbvps": "(R * 2) / Q",
}
_RATIOS = {
    "roe": "(R - C - D - T) / (R * 3 + A * 700.0e0)", "roa": "(R - C - D - T) / (R * 4 + A * 1000.0e0)", "roic": "(R - C - D) / (R * 2 + A * 100.0e0)", "grossmargin": "(R - C) / R", "netmargin": "(R - C - D - T) / R",
    "ebitdamargin": "(R - C - D + A * 0.5e0 + N * 20) / R", "ros": "(R - C - D) / R", "payoutratio": "T / R", "divyield": "T / (R * 10)",
    "sps": "R / Q", "dps": "CASE WHEN s % 5 = 0 THEN 0.0e0 ELSE T / Q END", "currentratio": "(R * 0.6e0 + A) / (C * 0.4e0)", "assetturnover": "R / (R * 4 + A * 1000.0e0)",
    "marketcap": "R * 12", "sharesbas": "Q", "shareswadil": "Q",
}
_ALL = {c: _FORMULAS.get(c, f"R * {0.01 + 0.001 * k:.3f}e0") for k, c in enumerate(INCOME + CASH_FLOW + BALANCE)} | {c: _FORMULAS[c] for c in ("fcfps", "bvps", "tbvps")} | _RATIOS

FIN = f"""
SELECT ticker, calendardate, reportperiod, fiscalperiod, fxusd, 1.0e0 AS sharefactor, {", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _ALL.items())}
FROM (SELECT CAST(s AS STRING) AS ticker, s, CAST(CAST(q AS DATE) + INTERVAL '3' MONTH - INTERVAL '1' DAY AS DATE) AS calendardate, max(d) AS reportperiod,
             concat(CAST(year(q) AS STRING), '-Q', CAST(quarter(q) AS STRING)) AS fiscalperiod, 1 + max(nk) / 100.0e0 AS fxusd,
             round(sum(p), 2) AS R, round(sum(qty * rp) / 2, 2) AS C, round(sum(p * disc), 4) AS D, round(sum(p * tax), 4) AS T, sum(qty) AS Q, CAST(count(*) AS DOUBLE) AS N, max(abs(bal)) AS A
      FROM (SELECT l_suppkey AS s, CAST(l_shipdate AS DATE) AS d, CAST(date_trunc('quarter', CAST(l_shipdate AS DATE)) AS DATE) AS q, l_extendedprice AS p, l_quantity AS qty,
                   l_discount AS disc, l_tax AS tax, p_retailprice AS rp, s_nationkey AS nk, s_acctbal AS bal
            FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN {{supplier}} ON l_suppkey = s_suppkey) x
      GROUP BY s, q) y"""

CO = """
SELECT CAST(s_suppkey AS STRING) AS ticker, s_name AS name, concat('www.', s_name) AS companysite, n_name AS location, 'USD' AS currency,
       CASE WHEN s_suppkey % 2 = 0 THEN 'X' ELSE 'Y' END AS exchange, 'common' AS category, r_name AS sector, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE n_name END AS industry,
       concat('sec/', s_name) AS secfilings, CAST(s_suppkey * 7 AS STRING) AS cusips, CASE WHEN s_suppkey % 10 = 3 THEN 'Y' ELSE 'N' END AS isdelisted
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""

INS = """
SELECT CAST(o_custkey % 100 AS STRING) AS ticker, '4' AS formtype, CAST(o_orderdate AS DATE) AS transactiondate, 'issuer' AS issuername, c_name AS ownername,
       CASE o_orderstatus WHEN 'F' THEN 'S' WHEN 'O' THEN 'P' ELSE 'M' END AS transactioncode, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'ND' END AS securityadcode,
       'Common' AS securitytitle, CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE c_mktsegment END AS officertitle,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'Y' ELSE 'N' END AS isofficer, CASE WHEN o_orderpriority LIKE '2%' THEN 'Y' ELSE 'N' END AS isdirector,
       CASE WHEN o_orderpriority LIKE '3%' THEN 'Y' ELSE 'N' END AS istenpercentowner,
       CASE WHEN o_orderstatus = 'F' THEN -o_totalprice ELSE o_totalprice END AS transactionvalue,
       CASE WHEN o_orderstatus = 'F' THEN -1.0e0 ELSE 1.0e0 END * (o_orderkey % 50 + 1) AS transactionshares, o_totalprice / (o_orderkey % 50 + 1) AS transactionpricepershare
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""

VIEWS = {"bars": BARS, "fin": FIN, "co": CO, "ins": INS}
assert set(MONEY + RATIOS) <= set(_ALL)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in VIEWS[name]}
    return spark.sql(VIEWS[name], **used)


def duck(name: str) -> str:
    """The view's text for DuckDB."""
    return VIEWS[name].format(**{t: t for t in TABLES})
