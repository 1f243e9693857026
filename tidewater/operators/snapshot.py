"""The company snapshot: one ranked row per active company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import col, safe_div, rnd
from tidewater.operators.panel import latest_per_key
from tidewater.operators.rank import snapshot_percentiles, weighted_score, weighted_score_neutral
from tidewater.sources.datasets import cut

COMPANY = "ticker name companysite location currency exchange category sector industry secfilings cusips".split()

# fixed values: metric, whether high is good, weight
QUALITY = [
    ("roic", True, 0.08), ("roce", True, 0.08), ("__q_gpassets_metric", True, 0.08), ("roe", True, 0.03), ("grossmargin", True, 0.06), ("__q_ebitmargin_metric", True, 0.06),
    ("revenuecagr3y", True, 0.04), ("__q_revenuecagr5y_metric", True, 0.04), ("__q_salesassetscagr3y_metric", True, 0.04), ("__q_grossprofitassetscagr3y_metric", True, 0.04),
    ("__q_opprofitassetscagr3y_metric", True, 0.04), ("__q_rndintensity_metric", True, 0.025), ("__q_rndcagr3y_metric", True, 0.025), ("__q_cfc_metric", True, 0.05),
    ("__q_fcfassets_metric", True, 0.05), ("__q_cashaccruals_metric", True, 0.05), ("__q_icr_metric", True, 0.04), ("de", False, 0.04), ("fsscore", True, 0.04),
    ("__q_cashassets_metric", True, 0.03), ("__q_intangiblesassets_metric", True, 0.03), ("bbyield", True, 0.03),
]
VALUE = [("__v_evebitda", False, 1 / 3), ("__v_evsales", False, 1 / 3), ("__v_peg", False, 1 / 3)]
EPS = [("epsqtrchg", True, 0.4), ("epsqtraccel", True, 0.3), ("epsqtryoy", True, 0.2), ("epscagr3y", True, 0.1)]
SMR = [("revenueqtryoy", True, 0.25), ("netmarginqtr", True, 0.25), ("pretaxmargin", True, 0.25), ("roe", True, 0.25)]
GROWTH = [("revenueqtraccel", True, 0.25), ("epsqtraccel", True, 0.25), ("grossmarginqtrexp", True, 0.15), ("ebitdamarginqtrexp", True, 0.2), ("roicqtrexp", True, 0.15)]
COMPOSITE = [("__c_epsrank", 0.3), ("rsrank", 0.3), ("__c_smrqrank", 0.15), ("adrank", 0.1), ("industryrank", 0.1), ("highrank", 0.05)]
MOMENTUM = [("growthrank", 0.45), ("rsrank", 0.45), ("volconfirmrank", 0.10)]
CONFIRMATION = [("momrank", 0.35), ("qualrank", 0.40), ("epsrank", 0.15)]
QUARTERLY = {
    "revenueqtryoy": "revenueqtryoy", "revenueqtraccel": "revenueqtraccel", "netmargin": "netmarginqtr", "epsadj": "epsqtr", "epsqtryoy": "epsqtryoy", "epsqtrchg": "epsqtrchg",
    "epsqtr1qagoyoy": "epsqtr1qagoyoy", "epsqtr2qagoyoy": "epsqtr2qagoyoy", "epsqtraccel": "epsqtraccel", "grossmarginqtrexp": "grossmarginqtrexp", "ebitdamarginqtrexp": "ebitdamarginqtrexp", "roicqtrexp": "roicqtrexp",
}
NOT_KEPT = ("sharefactor", "sps", "currentratio", "assetturnover", "marketcap", "shareswadil", "eps", "epsdil", "fcfps", "bvps", "tbvps")


def active_companies(df: DataFrame) -> DataFrame:
    return df.where("isdelisted = 'N'").select(*COMPANY)


def snapshot_valuation(df: DataFrame) -> DataFrame:
    step = df.withColumn("marketcap", col("sharesbas") * col("close")).withColumn("ev", F.col("marketcap") + col("netdebt"))
    return step.withColumn("peg", rnd(safe_div(safe_div("marketcap", "netinc"), col("revenuecagr3y")), 1))


def company_base(companies: DataFrame, prices: DataFrame, ttm: DataFrame, qtr: DataFrame, max_staleness_days: int | None = None) -> DataFrame:
    """Active companies with their last price row, last twelve months and last quarter.

    With ``max_staleness_days``, a company whose last price is older than that, counted
    from the newest price of all companies, is left out.
    """
    annual = ttm.drop(*[c for c in NOT_KEPT if c in ttm.columns])
    quarter = qtr.select("ticker", "calendardate", *[F.col(a).alias(b) for a, b in QUARTERLY.items()])
    last = latest_per_key(annual, "calendardate"), latest_per_key(quarter, "calendardate").drop("calendardate")
    priced = latest_per_key(prices, "date")
    if max_staleness_days is not None:
        newest = priced.agg(F.max("date")).first()[0]
        priced = priced.where(F.datediff(F.lit(newest), "date") <= max_staleness_days)
    joined = active_companies(companies).join(priced, "ticker")
    for side in last:
        joined = joined.join(side, "ticker")
    return snapshot_valuation(joined)


def value_multiples(df: DataFrame) -> DataFrame:
    """EV over EBITDA and sales, and the former over growth; a divisor must be positive, shrinking is dearest."""
    ev, ebitda, revenue, growth = (col(c) for c in ("ev", "ebitda", "revenue", "ebitda1y"))
    step = df.withColumns({"__v_evebitda": F.when((ev > 0) & (ebitda > 0), safe_div(ev, ebitda)), "__v_evsales": F.when((ev > 0) & (revenue > 0), safe_div(ev, revenue))})
    return step.withColumn("__v_peg", F.when(F.col("__v_evebitda").isNotNull(), F.when(growth > 0, safe_div(F.col("__v_evebitda"), growth)).when(growth <= 0, F.lit(1e9))))


def high_proximity(df: DataFrame) -> DataFrame:
    return df.withColumn("__high_proximity", F.when(col("max252") > 0, safe_div("close", "max252")))


def _blend(df: DataFrame, parts: list[tuple[str, bool, float]], alias: str, coverage: float) -> DataFrame:
    """Percentiles of the parts, blended by weight, without the percentiles."""
    names = [f"__b{k}" for k in range(len(parts))]
    ranked = snapshot_percentiles(df, [(c, up, n) for (c, up, _), n in zip(parts, names, strict=True)])
    return ranked.withColumn(alias, weighted_score([(n, w) for (_, _, w), n in zip(parts, names, strict=True)], coverage)).drop(*names)


def quality_rank(df: DataFrame) -> DataFrame:
    return _blend(df, QUALITY, "qualrank", 0.5)


def value_rank(df: DataFrame) -> DataFrame:
    return _blend(value_multiples(df), VALUE, "valuerank", 0.3).drop("__v_evebitda", "__v_evsales", "__v_peg")


def eps_smr_rank(df: DataFrame) -> DataFrame:
    return _blend(_blend(df, EPS, "epsrank", 0.5), SMR, "smrqrank", 0.5)


def growth_rank(df: DataFrame) -> DataFrame:
    return _blend(df, GROWTH, "growthrank", 0.5)


def industry_rank(df: DataFrame) -> DataFrame:
    """Percentiles of the industry's mean half-year change and of nearness to the year's high."""
    means = df.groupBy("industry").agg(F.avg(col("pct126")).alias("__mean"))
    ranked = snapshot_percentiles(means.withColumn("__key", F.coalesce("industry", F.lit("\x00"))), [("__mean", True, "industryrank")], "__key").select("industry", "industryrank")
    joined = high_proximity(df).join(ranked.where("industry is not null"), "industry", "left")
    return snapshot_percentiles(joined, [("__high_proximity", True, "highrank")]).drop("__high_proximity")


def composite_rank(df: DataFrame) -> DataFrame:
    step = snapshot_percentiles(df, [("epsrank", True, "__c_epsrank"), ("smrqrank", True, "__c_smrqrank")])
    return step.withColumn("comprank", weighted_score(COMPOSITE, 0.5)).drop("__c_epsrank", "__c_smrqrank")


def momentum_rank(df: DataFrame) -> DataFrame:
    return df.withColumn("momrank", weighted_score_neutral(MOMENTUM, 0.5))


def overall_score(df: DataFrame) -> DataFrame:
    conf = weighted_score_neutral(CONFIRMATION, 0.5).cast("double")
    core = F.when(F.col("valuerank").isNotNull(), 0.9 * F.col("__conf") + 0.1 * col("valuerank")).otherwise(F.col("__conf"))
    stab = (F.coalesce(col("industryrank"), F.lit(50.0)) + F.coalesce(col("highrank"), F.lit(50.0))) / 2
    step = df.withColumn("__conf", conf).withColumn("__core", rnd(core + 0.03 * stab, 6))
    return snapshot_percentiles(step, [("__core", True, "rankscore")]).drop("__conf", "__core")


def rank_companies(base: DataFrame) -> DataFrame:
    """All ranks over a snapshot.

    The percentiles of the first stage share one pass.  The snapshot is written
    between stages, since each reads it twice.
    """
    parts = {"qualrank": (QUALITY, 0.5), "valuerank": (VALUE, 0.3), "epsrank": (EPS, 0.5), "smrqrank": (SMR, 0.5), "growthrank": (GROWTH, 0.5)}
    names = {(alias, c): f"__{alias}_{k}" for alias, (ps, _) in parts.items() for k, (c, _, _) in enumerate(ps)}
    specs = [(c, up, names[alias, c]) for alias, (ps, _) in parts.items() for c, up, _ in ps]
    ranked = snapshot_percentiles(value_multiples(base), specs)
    for alias, (ps, coverage) in parts.items():
        ranked = ranked.withColumn(alias, weighted_score([(names[alias, c], w) for c, _, w in ps], coverage))
    ranked = ranked.drop(*names.values(), "__v_evebitda", "__v_evsales", "__v_peg", *[c for c in ranked.columns if c.endswith("_metric")])
    placed = cut(industry_rank(cut(ranked, "ranked")), "placed")
    return overall_score(cut(composite_rank(momentum_rank(placed)), "scored"))


def company_snapshot(companies: DataFrame, prices: DataFrame, ttm: DataFrame, qtr: DataFrame) -> DataFrame:
    return rank_companies(cut(company_base(companies, prices, ttm, qtr), "companies"))
