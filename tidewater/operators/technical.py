"""The daily and weekly technical pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import ewm, fractal, indicators
from tidewater.operators.blocks import Across, State, advance
from tidewater.operators.panel import resample_ohlcv
from tidewater.operators.rank import percentile


def series_steps() -> list[ewm.Step]:
    """Lags, frames and weighted means of the technical table."""
    row, close = ewm.of_row, F.col("close").cast("double")
    steps = [
        row(close * F.col("volume").cast("double"), "volumeusd", "close", "volume"),
        row(indicators.day_range(), "__day", "high", "low"), *[ewm.before("close", p) for p in indicators.CHANGE_PERIODS],
        *[row(indicators.change(close, F.col(f"__close_{p}")), f"pct{p}", "close", f"__close_{p}") for p in indicators.CHANGE_PERIODS],
        *indicators.VOLUME_STEPS, *indicators.sma_steps(), *indicators.highlow_steps(), ("max252", "lag", 1, "__max"), ("min252", "lag", 1, "__min"),
        ("__day", "mean", 20, "__adr"), ("close", "std", 20, "__dev"), *ewm.macd_steps(), *ewm.true_range_steps(), ewm.atr_step(20), *ewm.rsi_steps(14),
        *accumulation_steps(),
    ]
    return list({s[3]: s for s in steps}.values())


def accumulation_steps() -> list[ewm.Step]:
    """The accumulation score and what it reads, in one pass."""
    raw = indicators.by_usual_volume(indicators.pressure(F.col("__close_1")))
    return [indicators.VOLUME_STEPS[0], ewm.before("close"), ewm.of_row(raw, "__ad", "close", "high", "low", "volume", "__close_1", "avgvolume60", array=indicators.accumulation), ewm.AD_STEP]


RANKS = ("rsrank", "volumerocrank", "adrank", "volconfirmrank")
#: Columns that only other steps read.
_ON_THE_WAY = ("__day", "__tr", "__up", "__down", "__fast", "__slow", "__ad")


def with_series(bars: DataFrame, hurst_window: int | None = None, **options) -> DataFrame:
    """Adjusted bars with the columns that a ticker's own history gives; ``options`` as in ``blocks``."""
    steps, gone = series_steps(), _ON_THE_WAY
    if hurst_window:
        more = [*fractal.signal_steps(), fractal.exponent_step(hurst_window)]
        made = {s[3] for s in steps}
        steps, gone = [*steps, *[s for s in more if s[3] not in made]], (*gone, *[c for c in fractal.ON_THE_WAY if c not in made], "z")
    return _finished(ewm.ewm(bars, steps, drop=gone, **options))


def _finished(df: DataFrame) -> DataFrame:
    df = df.withColumns({f"pct{p}": F.col(f"pct{p}").cast("float") for p in indicators.CHANGE_PERIODS} | {"adr": F.col("__adr").cast("float")})
    df = df.withColumns(indicators.bands(F.col("sma20"), F.col("__dev")) | indicators.beyond(F.col("__max"), F.col("__min")))
    return indicators.rs_raw(indicators.volume_roc(df))


def technical_more(bars: DataFrame, state: State | None = None, written: bool = False) -> tuple[DataFrame, State]:
    """The rows of ``technical_daily``, dealt by ranges of tickers and in order, for bars that come after those that ``state`` stands for, and the state after them.

    A date comes whole: its percentiles are those of the rows in ``bars``.
    """
    df, after = advance(bars, series_steps(), state, across=_ranking(None), ranges=True, written=written)
    return _table(_finished(df)), after


def _ranking(unit: str | None) -> Across:
    """The percentiles, from what they read of the series alone: rows sort and travel by date while they are narrow."""
    read, steps = ("ad", "avgvolumeusd20", "avgvolumeusd126", *(f"pct{p}" for p in indicators.RS_PERIODS)), []
    wanted = set(read)
    for step in reversed(series_steps()):
        if step[3] in wanted:
            wanted |= set(step[0]) if isinstance(step[0], tuple) else {step[0]}
            steps.append(step)

    def ranked(rows: DataFrame) -> DataFrame:
        changed = rows.withColumns({f"pct{p}": F.col(f"pct{p}").cast("float") for p in indicators.RS_PERIODS})
        narrow = indicators.rs_raw(indicators.volume_roc(changed)).select("__key", "__block", "date", "__rs", "volumeroc", "ad")
        return ranks(narrow, unit).select("__key", "__block", "date", *RANKS)

    return steps[::-1], read, ranked


def ranks(df: DataFrame, unit: str | None = None) -> DataFrame:
    """Percentiles among all rows of a date, or of the ``unit`` ('week', ...) that the date is in.

    ``adrank`` and ``volconfirmrank`` stay doubles: blends round their sums at exact
    ties, which the last bits of a float would decide.
    """
    by = "date" if unit is None else "__unit"
    df = df if unit is None else df.withColumn(by, F.date_trunc(unit, "date"))
    df = percentile(df, "__rs", by, True, "rsrank")
    df = percentile(df, "volumeroc", by, True, "volumerocrank")
    df = percentile(df, "ad", by, True, "adrank", narrow=False)
    return percentile(indicators.volume_confirmed(df), "__volconfirm", by, True, "volconfirmrank", narrow=False)


def with_ranks(df: DataFrame, unit: str | None = None) -> DataFrame:
    """The technical table of rows that are few enough to be ranked whole."""
    return _table(ranks(df, unit))


def _table(df: DataFrame) -> DataFrame:
    df = df.withColumn("rs1y", F.col("rsrank"))
    last = [*RANKS, "rs1y"]
    return df.select(*[f"`{c}`" for c in df.columns if c not in ("volumeusd", "ad", *last) and not c.startswith("__")], *last)


def technical_daily(bars: DataFrame, hurst_window: int | None = None, rank_unit: str | None = None, ranges: bool = False, written: bool = False) -> DataFrame:
    """Every technical column over adjusted bars.

    One blocked pass makes all lags, frames, weighted means and the Hurst column (a
    repeated (ticker, date) fails there); percentiles are windows by date, or by
    ``rank_unit``, over narrow rows of a pass before.  The percentiles are dealt with the
    bars and put beside them before rows are made wide, so wide rows are never shuffled;
    with ``ranges`` they come dealt by ranges of tickers and in order.  ``written`` bars
    are read from files and not written once more.
    """
    df = _table(with_series(bars, hurst_window, across=_ranking(rank_unit), ranges=ranges, written=written))
    return df.select(*[c for c in df.columns if c != "hurst"], "hurst") if hurst_window else df


def technical_last(bars: DataFrame, tickers: DataFrame, written: bool = False) -> DataFrame:
    """The rows of ``technical_daily`` on the last dates of ``tickers``.

    Only those dates are ranked, and of the history before them only what the frames
    reach and the carries of the weighted means are made.
    """

    def last_dates(rows: DataFrame) -> DataFrame:
        return rows.join(tickers.select("ticker"), "ticker", "left_semi").groupBy("ticker").agg(F.max("date").alias("date"))

    return with_ranks(with_series(bars, only=last_dates, written=written))


def technical_weekly(bars: DataFrame, hurst_window: int | None = 100, rank_by: str = "date", ranges: bool = False) -> DataFrame:
    """The technical columns over weekly bars, with the exponent over 100 weeks unless ``hurst_window`` says otherwise.

    A week is labelled with the ticker's own first trading date; ``rank_by='period'``
    ranks all tickers of a calendar week together, whatever their labels.
    """
    return technical_daily(resample_ohlcv(bars, "week"), hurst_window, {"date": None, "period": "week"}[rank_by], ranges)
