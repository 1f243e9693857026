"""The SQL of each registered query, for DuckDB.

Wide relations (TECH, TTM, QTR, SNAP, ...) are written once; a query's SQL selects
its columns from one of them.
"""

from __future__ import annotations

from tidewater.sources.fixtures import AS_OF, duck

# fixed values, written out here so that a wrong one in an operator shows
MONEY = (
    "revenue cor sgna rnd opex intexp taxexp netincdis consolinc netincnci netinc prefdivis netinccmn eps epsdil ebt ebit ebitda gp opinc "
    "capex ncfbus ncfinv ncff ncfdebt ncfcommon ncfdiv ncfi ncfo ncfx ncf sbcomp depamor fcf "
    "assets cashneq investments investmentsc investmentsnc deferredrev deposits ppnenet inventory taxassets receivables payables intangibles liabilities equity retearn accoci assetsc assetsnc "
    "liabilitiesc liabilitiesnc taxliabilities debt debtc debtnc invcap equityavg assetsavg invcapavg tangibles workingcapital fcfps bvps tbvps"
).split()
RATIOS = "roe roa roic grossmargin netmargin ebitdamargin ros payoutratio divyield".split()
SCALES = {500: (7, 11, 17, 25, 38, 56, 84, 125), 100: (7, 9, 11, 13, 15, 18, 21, 24)}
QUALITY = (
    ("roic", 1, 0.08), ("roce", 1, 0.08), ("__q_gpassets_metric", 1, 0.08), ("roe", 1, 0.03), ("grossmargin", 1, 0.06), ("__q_ebitmargin_metric", 1, 0.06), ("revenuecagr3y", 1, 0.04),
    ("__q_revenuecagr5y_metric", 1, 0.04), ("__q_salesassetscagr3y_metric", 1, 0.04), ("__q_grossprofitassetscagr3y_metric", 1, 0.04), ("__q_opprofitassetscagr3y_metric", 1, 0.04),
    ("__q_rndintensity_metric", 1, 0.025), ("__q_rndcagr3y_metric", 1, 0.025), ("__q_cfc_metric", 1, 0.05), ("__q_fcfassets_metric", 1, 0.05), ("__q_cashaccruals_metric", 1, 0.05),
    ("__q_icr_metric", 1, 0.04), ("de", 0, 0.04), ("fsscore", 1, 0.04), ("__q_cashassets_metric", 1, 0.03), ("__q_intangiblesassets_metric", 1, 0.03), ("bbyield", 1, 0.03),
)
VALUE = (("__v_evebitda", 0, 1 / 3), ("__v_evsales", 0, 1 / 3), ("__v_peg", 0, 1 / 3))
EPS = (("epsqtrchg", 1, 0.4), ("epsqtraccel", 1, 0.3), ("epsqtryoy", 1, 0.2), ("epscagr3y", 1, 0.1))
SMR = (("revenueqtryoy", 1, 0.25), ("netmarginqtr", 1, 0.25), ("pretaxmargin", 1, 0.25), ("roe", 1, 0.25))
GROWTH = (("revenueqtraccel", 1, 0.25), ("epsqtraccel", 1, 0.25), ("grossmarginqtrexp", 1, 0.15), ("ebitdamarginqtrexp", 1, 0.2), ("roicqtrexp", 1, 0.15))
COMPOSITE = (("__c_epsrank", 0.3), ("rsrank", 0.3), ("__c_smrqrank", 0.15), ("adrank", 0.1), ("industryrank", 0.1), ("highrank", 0.05))
MOMENTUM = (("growthrank", 0.45), ("rsrank", 0.45), ("volconfirmrank", 0.10))
CONFIRMATION = (("momrank", 0.35), ("qualrank", 0.40), ("epsrank", 0.15))
NOT_KEPT = "sharefactor, sps, currentratio, assetturnover, marketcap, shareswadil, eps, epsdil, fcfps, bvps, tbvps"
LAST_QUARTER = (
    "revenueqtryoy, revenueqtraccel, netmargin AS netmarginqtr, epsadj AS epsqtr, epsqtryoy, epsqtrchg, epsqtr1qagoyoy, epsqtr2qagoyoy, epsqtraccel, grossmarginqtrexp, ebitdamarginqtrexp, roicqtrexp"
)
SCREEN = """ticker, name, exchange, close, pct1 AS pct1d, volume, sharesdil, marketcap, sector, industry, avgvolumeusd20 AS avgvolumeusd1m, revenue, revenueqtryoy, revenueyoy, revenuecagr3y, revenue5y,
  ev, ebitda, ebit, debt, cashneq AS cash, netinc, epsqtr, round(ev / nullif(ebitda, 0), 1) AS evebitda, round(ev / nullif(revenue, 0), 1) AS evsales, round(marketcap / nullif(equity, 0), 1) AS pb,
  round(netinc / nullif(sharesdil, 0), 2) AS eps, round(marketcap / nullif(netinc, 0), 1) AS pe, round(marketcap / nullif(netinc * epsyoy / 100, 0), 1) AS fwdpe, epsyoy, epscagr3y, epsqtryoy, fcf, fcfyoy, fcfcagr3y,
  round(marketcap / nullif(revenue, 0), 1) AS ps, round(marketcap / nullif(fcf, 0), 1) AS pfcf,
  round(ev / nullif(netinc, 0) / nullif(least(epscagr3y, revenuecagr3y, epsyoy, revenueyoy) + coalesce(100 * dps / nullif(close, 0), 0), 0), 1) AS peg, dps, dpscagr5y, round(100 * dps / nullif(close, 0), 2) AS divyield,
  round(100 * dps / nullif(round(netinc / nullif(sharesdil, 0), 2), 0), 1) AS divpayoutratio, roa, roe, roic, de, grossmargin, ebitdamargin, netmargin, pct5 AS pct1w, pct21 AS pct1m, pct63 AS pct3m, pct126 AS pct6m, pct252 AS pct12m,
  atr20 AS atr, rsi14 AS rsi, sma20, sma50, sma200, max252, min252, qualrank, rsrank, growthrank, momrank, valuerank, rankscore,
  revenueqtraccel > 0 AS revenuetrend, epsqtraccel > 0 AND epsqtr1qagoyoy > epsqtr2qagoyoy AS epstrend"""
METRICS = """ticker, name, exchange, marketcap, netdebt, netinc, fcf, close, pct1 AS pct1d, max252 AS max1y, min252 AS low1y, rankscore, qualrank, growthrank, momrank, valuerank,
  revenueyoy, revenuecagr3y, epsyoy, epscagr3y, grossmargin, netmargin, de, roe, roic, dps"""

T = "(PARTITION BY ticker ORDER BY date)"


def full(agg: str, x: str, n: int) -> str:
    w = f"OVER (PARTITION BY ticker ORDER BY date ROWS {n - 1} PRECEDING)"
    return f"CASE WHEN count({x}) {w} >= {n} THEN {agg}({x}) {w} END"


def ewm(x: str, i: str, top: str, bottom: str, least: int) -> str:
    """Adjusted weighted mean with alpha = top / bottom by prefix sums (short histories only)."""
    w = f"pow(1 - {top}e0 / {bottom}, -({i}))"
    return f"CASE WHEN {i} >= {least} THEN sum({x} * {w}) OVER {T} / sum(CASE WHEN {x} IS NOT NULL THEN {w} END) OVER {T} END"


def percentile(x: str, by: str, single: str = "NULL", up: str = "") -> str:
    p = f"PARTITION BY {by}" if by else ""
    pv = f"PARTITION BY {by}, {x}" if by else f"PARTITION BY {x}"
    n = f"count({x}) OVER ({p})"
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {n} > 1 THEN round((rank() OVER ({p} ORDER BY {x} {up} NULLS LAST) + (count({x}) OVER ({pv}) - 1) / 2.0e0 - 1) / ({n} - 1) * 100, 2) ELSE {single} END"
    )


def f32(x: str) -> str:
    return f"CAST(CAST({x} AS FLOAT) AS DOUBLE)"


PX = f"SELECT ticker, date, open * f AS open, high * f AS high, low * f AS low, closeadj AS close, volume FROM (SELECT *, closeadj / nullif(close, 0) AS f FROM ({duck('bars')}) b) b"


def resampled(unit: str) -> str:
    return f"SELECT ticker, min(date) AS date, min_by(open, date) AS open, max(high) AS high, min(low) AS low, max_by(close, date) AS close, coalesce(sum(volume), 0) AS volume FROM ({PX}) p GROUP BY ticker, date_trunc('{unit}', date)"


def tech(px: str, by: str = "date") -> str:
    sma = ", ".join(f"{full('avg', 'close', p)} AS sma{p}" for p in (10, 20, 50, 100, 150, 200))
    ext = ", ".join(f"{full('min', 'low', w)} AS min{w}, {full('max', 'high', w)} AS max{w}" for w in (20, 55, 252))
    chg = ", ".join(f"{f32(f'round((close / nullif(lag(close, {p}) OVER {T}, 0) - 1) * 100, 2)')} AS pct{p}" for p in (1, 5, 21, 63, 126, 189, 252))
    return f"""
WITH px AS ({px}),
a AS (SELECT *, close * volume AS volumeusd, lag(close) OVER {T} AS pc, row_number() OVER {T} AS rn, (high / nullif(low, 0) - 1) * 100 AS day FROM px),
b AS (SELECT *, {sma}, {ext}, {chg}, {f32(full("avg", "day", 20))} AS adr, {full("avg", "close", 20)} + 2 * {full("stddev_samp", "close", 20)} AS bbtop, {full("avg", "close", 20)} - 2 * {full("stddev_samp", "close", 20)} AS bbbot,
      {full("avg", "volume", 60)} AS avgvolume60, {full("avg", "volumeusd", 20)} AS avgvolumeusd20, {full("avg", "volumeusd", 126)} AS avgvolumeusd126,
      CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
      CASE WHEN close - pc > 0 THEN close - pc ELSE 0 END AS up, CASE WHEN close - pc < 0 THEN pc - close ELSE 0 END AS down FROM a),
c AS (SELECT *, close > lag(max252) OVER {T} AS high252, close < lag(min252) OVER {T} AS low252, CASE WHEN avgvolumeusd126 > 0 THEN {f32("avgvolumeusd20 / avgvolumeusd126 - 1")} END AS volumeroc,
      {f32("0.4e0 * pct63 + 0.2e0 * pct126 + 0.2e0 * pct189 + 0.2e0 * pct252")} AS rs,
      CASE WHEN avgvolume60 > 0 THEN (0.7e0 * sign(close - pc) + 0.3e0 * CASE WHEN high - low > 0 THEN (2 * close - high - low) / (high - low) ELSE 0 END) * (volume / avgvolume60) END AS ad0 FROM b),
d AS (SELECT *, count(ad0) OVER {T} AS ia FROM c),
e AS (SELECT *, {ewm("close", "rn", "2", "13", 12)} - {ewm("close", "rn", "2", "27", 26)} AS macd, {ewm("tr", "(rn - 1)", "1", "20", 20)} AS atr20, {ewm("up", "rn", "1", "14", 14)} AS gain, {ewm("down", "rn", "1", "14", 14)} AS loss,
      {ewm("ad0", "ia", "2", "66", 20)} AS ad, {ewm("close", "rn", "2", "11", 10)} AS ema10, {ewm("close", "rn", "2", "21", 20)} AS ema20 FROM d),
f AS (SELECT *, count(macd) OVER {T} AS im FROM e),
g AS (SELECT *, {ewm("macd", "im", "2", "10", 9)} AS macd_signal, CASE WHEN loss = 0 AND gain > 0 THEN 100.0e0 WHEN loss > 0 THEN 100 - 100 / (1 + gain / loss) END AS rsi14,
      {f32(percentile("rs", by))} AS rsrank, {f32(percentile("volumeroc", by))} AS volumerocrank, CASE WHEN ad IS NULL THEN NULL ELSE {percentile("ad", by)} END AS adrank FROM f),
h AS (SELECT *, (rsrank - 50) / 50 * (volumerocrank / 100) AS volconfirm, rsrank AS rs1y FROM g),
tech AS (SELECT *, {percentile("volconfirm", by)} AS volconfirmrank FROM h)
"""


DAILY, WEEKLY = tech(PX), tech(resampled("week"))
WEEKLY_BY_PERIOD = tech(resampled("week"), "date_trunc('week', date)")

L = lambda x, n: f"lag({x}, {n}) OVER (PARTITION BY ticker ORDER BY calendardate)"
Q = "OVER (PARTITION BY ticker ORDER BY calendardate)"


def change(x: str, n: int) -> str:
    return f"round(({x} - {L(x, n)}) / nullif(abs({L(x, n)}), 0) * 100, 1)"


def cagr(x: str, y: int) -> str:
    return f"CASE WHEN {x} > 0 AND {L(x, 4 * y)} > 0 THEN round((pow({x} / {L(x, 4 * y)}, 1.0e0 / {y}) - 1) * 100, 1) END"


def pct(n: str, d: str) -> str:
    return f"round(100 * (({n}) / nullif({d}, 0)), 1)"


def ratio(n: str, d: str) -> str:
    return f"round(({n}) / nullif({d}, 0), 3)"


def adjusted(ttm: bool) -> str:
    """CTEs fin -> n3 (normalised, with adjusted earnings)."""
    fx = ", ".join(f"{c} / nullif(fxusd, 0) AS {c}" for c in MONEY)
    ratios = ", ".join(f"round(100 * {c}, 1) AS {c}" for c in RATIOS)
    more = f"{pct('ebit', 'revenue')} AS ebitmargin, {ratio('debt', 'equity')} AS de," if ttm else ""
    debt = "round(debt - cashneq, 2)" if ttm else "debt - cashneq"
    return f"""fin AS ({duck("fin")}), n1 AS (SELECT * REPLACE ({fx}) FROM fin),
n2 AS (SELECT * REPLACE ({ratios}, sharesbas * sharefactor AS sharesbas), {more} shareswadil * sharefactor AS sharesdil FROM n1),
n3 AS (SELECT *, round(netincadj / nullif(sharesdil, 0), 2) AS epsadj FROM (SELECT *, round(netinccmn - netincdis, 2) AS netincadj, {debt} AS netdebt FROM n2) x)"""


def _fscore() -> str:
    cash, before = "fcf / nullif(assets, 0)", f"{L('fcf', 4)} / nullif({L('assets', 4)}, 0)"
    tests = ["roa > 0", f"{cash} > 0", f"{cash} > roa", f"de < {L('de', 4)}", f"currentratio > {L('currentratio', 4)}", f"shareswadil <= {L('shareswadil', 4)}", f"roa > {L('roa', 4)}", f"{cash} > {before}", f"grossmargin > {L('grossmargin', 4)}", f"assetturnover > {L('assetturnover', 4)}"]
    return " + ".join(f"CAST(coalesce({t}, false) AS INT)" for t in tests)


TTM = f"""
{adjusted(True)},
t1 AS (SELECT *, round(ebit - netincdis, 2) AS ebitadj FROM n3),
t2 AS (SELECT *, {pct("ebitadj", "assets - liabilitiesc")} AS roce, {pct("ebt", "revenue")} AS pretaxmargin, {pct("-1.0e0 * ncfcommon", "marketcap")} AS bbyield, {cagr("dps", 5)} AS dpscagr5y,
       ncfo - netincdis - (depamor + sbcomp) - (workingcapital - {L("workingcapital", 1)}) AS fcf0 FROM t1),
t3 AS (SELECT *, round(fcf0, 2) AS fcfadj, round(fcf0 / nullif(sharesdil, 0), 2) AS fcfpsadj, ebitda / nullif(sharesdil, 0) AS ebitdaps FROM t2),
ttm AS (SELECT *, {change("sps", 4)} AS revenueyoy, {change("sps", 20)} AS revenue5y, {cagr("sps", 3)} AS revenuecagr3y, {cagr("sps", 5)} AS revenuecagr5y, {change("ebitdaps", 4)} AS ebitda1y,
       {cagr("ebitdaps", 3)} AS ebitdacagr3y, {cagr("ebitdaps", 5)} AS ebitdacagr5y, {change("epsadj", 4)} AS epsyoy, {cagr("epsadj", 3)} AS epscagr3y, {cagr("epsadj", 5)} AS epscagr5y,
       {change("fcfpsadj", 4)} AS fcfyoy, {cagr("fcfpsadj", 3)} AS fcfcagr3y, {cagr("fcfpsadj", 5)} AS fcfcagr5y, {_fscore()} AS fsscore,
       {pct("ebitadj", "revenue")} AS __q_ebitmargin_metric, {cagr("sps", 5)} AS __q_revenuecagr5y_metric, {cagr("assetturnover", 3)} AS __q_salesassetscagr3y_metric,
       {cagr("(gp / nullif(assets, 0))", 3)} AS __q_grossprofitassetscagr3y_metric, {cagr("(opinc / nullif(assets, 0))", 3)} AS __q_opprofitassetscagr3y_metric, {pct("rnd", "revenue")} AS __q_rndintensity_metric,
       {cagr("rnd", 3)} AS __q_rndcagr3y_metric, {ratio("ncfo", "opinc")} AS __q_cfc_metric, {ratio("fcf", "assets")} AS __q_fcfassets_metric, {ratio("ncfo - ebitadj", "assets")} AS __q_cashaccruals_metric,
       {ratio("ebitadj", "intexp")} AS __q_icr_metric, {ratio("cashneq", "assets")} AS __q_cashassets_metric, {ratio("gp", "assets")} AS __q_gpassets_metric, {ratio("intangibles", "assets")} AS __q_intangiblesassets_metric FROM t3)
"""

QTR = f"""
{adjusted(False)}, px0 AS ({PX}),
q1 AS (SELECT n3.*, CASE WHEN date_diff('day', p.date, n3.reportperiod) <= 10 THEN p.close END AS report_close FROM n3 ASOF LEFT JOIN px0 p ON n3.ticker = p.ticker AND n3.reportperiod >= p.date),
q2 AS (SELECT *, {change("sps", 4)} AS revenueqtryoy, {change("epsadj", 4)} AS epsqtryoy, CASE WHEN report_close > 0 THEN round((epsadj - {L("epsadj", 4)}) / report_close * 100, 3) END AS epsqtrchg FROM q1),
qtr AS (SELECT *, revenueqtryoy - {L("revenueqtryoy", 1)} AS revenueqtraccel, {L("epsqtrchg", 1)} AS epsqtr1qagoyoy, {L("epsqtrchg", 2)} AS epsqtr2qagoyoy, (epsqtrchg - {L("epsqtrchg", 2)}) / 2 AS epsqtraccel,
       grossmargin - {L("grossmargin", 4)} AS grossmarginqtrexp, ebitdamargin - {L("ebitdamargin", 4)} AS ebitdamarginqtrexp, roic - {L("roic", 4)} AS roicqtrexp FROM q2)
"""


def _blend(parts: list[tuple[str, float]], coverage: float, neutral: bool = False) -> str:
    total = sum(w for _, w in parts)
    held = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN {w!r}e0 ELSE 0 END" for c, w in parts)
    value = " + ".join(f"coalesce({c}, {50 if neutral else 0}) * {w!r}e0" for c, w in parts)
    by = repr(total) + "e0" if neutral else f"({held})"
    return f32(f"CASE WHEN ({held}) >= {coverage * total - 1e-12!r}e0 AND ({held}) > 0 THEN round(({value}) / {by}, 2) END")


def _ranks(parts, alias: str) -> str:
    return ", ".join(f32(percentile(c, "", "100.0e0", "" if up else "DESC")) + f" AS {alias}_{k}" for k, (c, up, _) in enumerate(parts))


def _weights(parts, alias: str) -> list[tuple[str, float]]:
    return [(f"{alias}_{k}", w) for k, (_, _, w) in enumerate(parts)]


SNAP = f"""
{DAILY.strip()}, {TTM.replace("px0", "px1")}, {", ".join(x for x in [QTR.replace("fin AS", "qfin AS").replace("FROM fin", "FROM qfin").replace("n1 AS", "qn1 AS").replace("FROM n1", "FROM qn1").replace("n2 AS", "qn2 AS").replace("FROM n2", "FROM qn2").replace("n3 AS", "qn3 AS").replace("n3.", "qn3.").replace("FROM n3", "FROM qn3")])},
lp AS (SELECT * FROM tech QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY date DESC) = 1),
lt AS (SELECT * EXCLUDE ({NOT_KEPT}) FROM ttm QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY calendardate DESC) = 1),
lq AS (SELECT ticker, {LAST_QUARTER} FROM qtr QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY calendardate DESC) = 1),
s0 AS (SELECT c.* EXCLUDE (isdelisted), lp.* EXCLUDE (ticker), lt.* EXCLUDE (ticker), lq.* EXCLUDE (ticker) FROM (SELECT * FROM ({duck("co")}) WHERE isdelisted = 'N') c JOIN lp ON lp.ticker = c.ticker JOIN lt ON lt.ticker = c.ticker JOIN lq ON lq.ticker = c.ticker),
s1 AS (SELECT *, marketcap + netdebt AS ev, round(marketcap / nullif(netinc, 0) / nullif(revenuecagr3y, 0), 1) AS peg FROM (SELECT *, sharesbas * close AS marketcap FROM s0) x),
s2 AS (SELECT *, CASE WHEN ev > 0 AND ebitda > 0 THEN ev / ebitda END AS __v_evebitda, CASE WHEN ev > 0 AND revenue > 0 THEN ev / revenue END AS __v_evsales, CASE WHEN max252 > 0 THEN close / max252 END AS high_proximity FROM s1),
s3 AS (SELECT *, CASE WHEN __v_evebitda IS NULL THEN NULL WHEN ebitda1y > 0 THEN __v_evebitda / ebitda1y WHEN ebitda1y <= 0 THEN 1e9 END AS __v_peg FROM s2),
s4 AS (SELECT *, {_ranks(QUALITY, "qq")}, {_ranks(VALUE, "vv")}, {_ranks(EPS, "ee")}, {_ranks(SMR, "mm")}, {_ranks(GROWTH, "gg")}, {f32(percentile("high_proximity", "", "100.0e0"))} AS highrank FROM s3),
im AS (SELECT industry, {f32(percentile("m", "", "100.0e0"))} AS industryrank FROM (SELECT industry, avg(pct126) AS m FROM s3 GROUP BY industry) x),
s5 AS (SELECT s4.*, industryrank, {_blend(_weights(QUALITY, "qq"), 0.5)} AS qualrank, {_blend(_weights(VALUE, "vv"), 0.3)} AS valuerank, {_blend(_weights(EPS, "ee"), 0.5)} AS epsrank,
       {_blend(_weights(SMR, "mm"), 0.5)} AS smrqrank, {_blend(_weights(GROWTH, "gg"), 0.5)} AS growthrank FROM s4 LEFT JOIN im ON s4.industry = im.industry),
s6 AS (SELECT *, {f32(percentile("epsrank", "", "100.0e0"))} AS __c_epsrank, {f32(percentile("smrqrank", "", "100.0e0"))} AS __c_smrqrank, {_blend(MOMENTUM, 0.5, True)} AS momrank FROM s5),
s7 AS (SELECT *, {_blend(COMPOSITE, 0.5)} AS comprank, {_blend(CONFIRMATION, 0.5, True)} AS conf FROM s6),
s8 AS (SELECT *, round(CASE WHEN valuerank IS NOT NULL THEN 0.9e0 * conf + 0.1e0 * valuerank ELSE conf END + 0.03e0 * ((coalesce(industryrank, 50) + coalesce(highrank, 50)) / 2), 6) AS core FROM s7),
snap AS (SELECT *, {percentile("core", "", "100.0e0")} AS rankscore FROM s8)
"""

INSIDERS = f"""
WITH recent AS (SELECT * REPLACE (isofficer = 'Y' AS isofficer, isdirector = 'Y' AS isdirector, istenpercentowner = 'Y' AS istenpercentowner) FROM (SELECT * RENAME (transactiondate AS date) FROM ({duck("ins")}) i) i
  WHERE date >= CAST(DATE '{AS_OF}' - INTERVAL 182 DAY AS DATE) AND transactionvalue <> 0),
daily AS (SELECT ticker, date, issuername, ownername, transactioncode, securityadcode, securitytitle, officertitle, isofficer, isdirector, istenpercentowner,
  coalesce(sum(transactionvalue), 0) AS transactionvalue, coalesce(sum(abs(transactionshares)), 0) AS transactionshares, avg(transactionpricepershare) AS transactionpricepershare FROM recent GROUP BY ALL),
insiders AS (SELECT * REPLACE (CASE WHEN isofficer THEN coalesce(officertitle, '') WHEN isdirector THEN 'Director' WHEN istenpercentowner THEN '10% Owner' ELSE coalesce(officertitle, '') END AS officertitle) FROM daily)
"""

UNIVERSE = f"""
WITH f AS (SELECT ticker, reportperiod, max_by(roe, calendardate) AS roe, max_by(netmargin, calendardate) AS netmargin FROM ({duck("fin")}) x WHERE reportperiod IS NOT NULL GROUP BY ticker, reportperiod),
life AS (SELECT ticker, min(reportperiod) AS lo, max(reportperiod) AS hi FROM f GROUP BY ticker),
u AS (SELECT ticker, d AS reportperiod FROM (SELECT DISTINCT reportperiod AS d FROM f) JOIN life ON d BETWEEN lo AND CAST(hi + INTERVAL 366 DAY AS DATE)),
known AS (SELECT u.ticker, u.reportperiod, CASE WHEN date_diff('day', f.reportperiod, u.reportperiod) <= 366 THEN roe END AS roe, CASE WHEN date_diff('day', f.reportperiod, u.reportperiod) <= 366 THEN netmargin END AS netmargin
  FROM u ASOF LEFT JOIN f ON u.ticker = f.ticker AND u.reportperiod >= f.reportperiod),
k1 AS (SELECT * FROM known WHERE roe IS NOT NULL OR netmargin IS NOT NULL),
ranked AS (SELECT ticker, reportperiod, {f32(percentile("roe", "reportperiod", "100.0e0"))} AS roerank, CASE WHEN netmargin IS NOT NULL THEN rank() OVER (PARTITION BY reportperiod ORDER BY netmargin DESC NULLS LAST) + (count(netmargin) OVER (PARTITION BY reportperiod, netmargin) - 1) / 2.0e0 END AS marginplace FROM k1)
"""


def hurst_sql(window: int, px: str = PX, reverse: bool = False) -> str:
    scales = SCALES[window]
    back = lambda s: [window - 1, (window // s) * s - 1][: 1 + reverse]
    total = lambda s: "(" + " + ".join(f"lag(s{s}, {k}) OVER {T}" for k in back(s)) + ")"
    box = lambda s: f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND {s - 1} FOLLOWING)"
    res = ", ".join(f"greatest(0, regr_syy(c, x) {box(s)} - pow(regr_sxy(c, x) {box(s)}, 2) / nullif(regr_sxx(c, x) {box(s)}, 0)) AS r{s}" for s in scales)
    sums = ", ".join(f"sum(r{s}) OVER (PARTITION BY ticker, rn % {s} ORDER BY rn ROWS BETWEEN CURRENT ROW AND {window // s - 1} FOLLOWING) AS s{s}" for s in scales)
    lags = " UNION ALL ".join(f"SELECT ticker, date, ok, ln({s}) AS lx, CASE WHEN {total(s)} > 0 THEN 0.5e0 * ln({total(s)} / {len(back(s)) * (window // s) * s}) END AS ly FROM h3" for s in scales)
    return f"""
WITH px AS ({px}),
h0 AS (SELECT *, row_number() OVER {T} AS rn, lag(close) OVER {T} AS pc, 0.5e0 * pow(ln(high / nullif(low, 0)), 2) - (2 * ln(2) - 1) * pow(ln(close / nullif(open, 0)), 2) AS gk FROM px),
h1 AS (SELECT *, sqrt(greatest(avg(gk) OVER w, 1e-12)) AS sigma, avg(CASE WHEN volume > 0 THEN volume END) OVER w AS vbar FROM h0 WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING)),
sig AS (SELECT *, CASE WHEN rn >= 20 THEN ln(close / nullif(pc, 0)) * sqrt(volume / nullif(vbar, 0)) / nullif(sigma, 0) END AS z FROM h1),
h2 AS (SELECT ticker, date, rn, CAST(rn AS DOUBLE) AS x, sum(coalesce(z - m, 0)) OVER {T} AS c, count(z) OVER (PARTITION BY ticker ORDER BY date ROWS {window - 1} PRECEDING) >= {window} AS ok FROM (SELECT *, avg(z) OVER (PARTITION BY ticker) AS m FROM sig) y),
h3 AS (SELECT *, {sums} FROM (SELECT *, {res} FROM h2) y),
h4 AS ({lags})
"""


def cols(*items: str) -> str:
    """'name:digits' rounds, 'name' does not."""
    out = []
    for item in items:
        name, _, digits = item.partition(":")
        out.append(f"round(CAST({name} AS DOUBLE), {digits}) AS {name}" if digits else name)
    return ", ".join(out)
