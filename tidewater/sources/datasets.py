"""Datasets: schemas, CSV staging, table sinks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# fixed values: column names of the input datasets
INCOME = "revenue cor sgna rnd opex intexp taxexp netincdis consolinc netincnci netinc prefdivis netinccmn eps epsdil ebt ebit ebitda gp opinc".split()
CASH_FLOW = "capex ncfbus ncfinv ncff ncfdebt ncfcommon ncfdiv ncfi ncfo ncfx ncf sbcomp depamor fcf".split()
BALANCE = "assets cashneq investments investmentsc investmentsnc deferredrev deposits ppnenet inventory taxassets receivables payables intangibles liabilities equity retearn accoci assetsc assetsnc liabilitiesc liabilitiesnc taxliabilities debt debtc debtnc invcap equityavg assetsavg invcapavg tangibles workingcapital".split()
PER_SHARE = "fcfps bvps tbvps".split()
#: Columns in reporting currency; sps and dps are not among them.
MONEY = INCOME + CASH_FLOW + BALANCE + PER_SHARE
RATIOS = "roe roa roic grossmargin netmargin ebitdamargin ros payoutratio divyield".split()
OTHER = "sps dps currentratio assetturnover marketcap sharesbas shareswadil".split()
DROPPED = "equityusd epsusd revenueusd netinccmnusd cashnequsd debtusd ebitusd ebitdausd dimension lastupdated".split()

_STATEMENT = "ticker string, calendardate date, reportperiod date, fiscalperiod string, fxusd double, sharefactor double, " + ", ".join(f"{c} double" for c in MONEY + RATIOS + OTHER)

SCHEMAS = {
    "stocks_prices": "ticker string, date date, open double, high double, low double, close double, closeadj double, volume double",
    "companies": "ticker string, name string, companysite string, location string, currency string, exchange string, category string, sector string, industry string, secfilings string, cusips string, isdelisted string",
    "financials_ttm": _STATEMENT,
    "financials_qtr": _STATEMENT,
    "insiders": "ticker string, formtype string, transactiondate date, issuername string, ownername string, transactioncode string, securityadcode string, securitytitle string, officertitle string, isofficer string, isdirector string, istenpercentowner string, transactionvalue double, transactionshares double, transactionpricepershare double",
}


def read_csv(spark: SparkSession, path: str, name: str | None = None, schema: str | None = None) -> DataFrame:
    """A CSV file with a header under the dataset's schema, or an explicit one; nothing is inferred."""
    return spark.read.csv(path, header=True, schema=schema or SCHEMAS[name], enforceSchema=False)


def stage_dataset(spark: SparkSession, csv: str, parquet: str, name: str | None = None, schema: str | None = None) -> DataFrame:
    """CSV to Parquet, read back lazily."""
    read_csv(spark, csv, name, schema).write.mode("overwrite").parquet(parquet)
    return spark.read.parquet(parquet)


def save_table(df: DataFrame, name: str, explain: bool = False, order: tuple[str, ...] = ()) -> DataFrame:
    """Replace table ``name`` by ``df`` and return the table.

    Rows go to a new shared folder, dealt by ranges of ``order`` and sorted by it, so
    that readers of a few keys skip the other files.  Only when they are all
    written does the name move to the new folder, and then the old one is deleted,
    if an earlier call of this function made it; a reader finds the old rows or the new.
    """
    if not name:
        raise ValueError("a table needs a name")
    if explain:
        df.explain("formatted")
    spark, path = df.sparkSession, scratch(df.sparkSession, f"table-{name}")
    _write(df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df, path)
    old = table_location(spark, name)
    if old and spark.table(name).schema == spark.read.parquet(path).schema:
        spark.sql(f"ALTER TABLE `{name}` SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        spark.sql(f"CREATE TABLE `{name}` USING parquet OPTIONS (compression 'zstd') LOCATION '{path}'")
    if old and f"/table-{name}-" in old:
        delete_folder(spark, old)
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str | None:
    """The folder of a table, if there is such a table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all executors share.

    Without that setting a local session gets a temporary folder, a cluster an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="tidewater-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_PASSING: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What ``cut`` writes within is deleted at the end, so what was made of it must be written by then."""
    _PASSING.append([])
    try:
        yield
    finally:
        for path in _PASSING.pop():
            delete_folder(spark, path)


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """``df`` written once and read back, for plans that would make it several times."""
    path = scratch(df.sparkSession, name)
    if _PASSING:
        _PASSING[-1].append(path)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_LET_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for a write within leaves the disk with the end of the write, not when the driver next collects garbage."""
    was = spark.conf.get(_LET_GO, None)
    spark.conf.set(_LET_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(_LET_GO) if was is None else spark.conf.set(_LET_GO, was)


def _write(df: DataFrame, path: str) -> None:
    with letting_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
