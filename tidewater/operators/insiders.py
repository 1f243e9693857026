"""Insider transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.expr import col

GROUP = "ticker date formtype issuername ownername transactioncode securityadcode securitytitle officertitle isofficer isdirector istenpercentowner".split()
KEYS = [k for k in GROUP if k != "formtype"]


def insider_recent(df: DataFrame, as_of: str, weeks: int = 26) -> DataFrame:
    """Transactions of the last ``weeks`` before ``as_of`` that have a value; Y and N become booleans."""
    flags = {c: F.col(c) == "Y" for c in ("isofficer", "isdirector", "istenpercentowner")}
    recent = df.where((F.col("transactiondate") >= F.date_sub(F.lit(as_of).cast("date"), 7 * weeks)) & (F.col("transactionvalue") != 0))
    return recent.withColumns(flags).withColumnRenamed("transactiondate", "date")


def insider_daily(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS).agg(
        F.coalesce(F.sum(col("transactionvalue")), F.lit(0.0)).alias("transactionvalue"),
        F.coalesce(F.sum(F.abs(col("transactionshares"))), F.lit(0.0)).alias("transactionshares"),
        F.avg(col("transactionpricepershare")).alias("transactionpricepershare"),
    )


def insider_titles(df: DataFrame) -> DataFrame:
    own = F.coalesce("officertitle", F.lit(""))
    return df.withColumn("officertitle", F.when(F.col("isofficer"), own).when(F.col("isdirector"), "Director").when(F.col("istenpercentowner"), "10% Owner").otherwise(own))


def insiders(df: DataFrame, as_of: str) -> DataFrame:
    """Recent transactions by day and owner, latest and largest first; titles are set after grouping."""
    return insider_titles(insider_daily(insider_recent(df, as_of)).orderBy(F.desc("date"), F.desc("transactionvalue")))
