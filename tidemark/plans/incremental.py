"""Bring the lake up to date after the bars of some months have changed.

Only what can differ is read and rewritten:

* silver and the monthly layer: the changed months;
* the yearly layer: their years;
* the daily metrics: their years, and later years that hold rows of a changed
  ticker whose trailing frames or previous close reach back into a changed month.  The rows that such a
  frame needs from before a rewritten year are found by the monthly layer's day
  counts, so just their months are read, and just for the tickers that need them.

The plan of a refresh is a handful of (year, month) numbers on the driver, at
most one per month of the history.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.plans import layers
from tidemark.plans.lake import Lake
from tidemark.session import scratch_path

Month = tuple[int, int]

# Rows before a day that its metrics look at: previous close, volume mean, volatility.
ROWS_BACK = max(1, C.LONG_ROWS, C.SHORT_ROWS - 1, C.VOLATILITY_ROWS - 1)


class Refreshed(NamedTuple):
    """What a refresh rewrote, and the months it read besides for trailing frames."""
    months: list[Month]
    years: list[int]
    daily_years: list[int]
    context: list[Month]


def months_of(bars: DataFrame, date: str = "trade_date") -> list[Month]:
    """The months that bars fall in."""
    found = bars.where(F.col(date).isNotNull()).select(F.year(date).alias("y"), F.month(date).alias("m")).distinct().collect()
    return sorted((r.y, r.m) for r in found)


def _in_months(months: Iterable[Month]) -> Column:
    """Filter on the partition columns year and month."""
    return (F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months])


def _in_ranges(months: list[Month], date: str) -> Column:
    """Date ranges of the months, neighbours joined, for a table that is not partitioned by month."""
    numbers = sorted({y * 12 + m - 1 for y, m in months})
    runs: list[list[int]] = []
    for n in numbers:
        if runs and runs[-1][1] == n:
            runs[-1][1] = n + 1
        else:
            runs.append([n, n + 1])

    def first_day(n: int) -> Column:
        return F.lit(f"{n // 12:04d}-{n % 12 + 1:02d}-01").cast("date")

    within = F.lit(False)
    for low, high in runs:
        within = within | ((F.col(date) >= first_day(low)) & (F.col(date) < first_day(high)))
    return within


def _period() -> Column:
    return F.col("year") * 100 + F.col("month")


def changed_tickers(monthly: DataFrame, months: list[Month], late: DataFrame | None = None) -> DataFrame:
    """(ticker, year, month) that may have changed: those of the ``late`` bars, or
    every ticker in every one of the months."""
    if late is not None:
        return late.select("ticker", F.year("trade_date").alias("year"), F.month("trade_date").alias("month")).distinct()
    at = F.array(*[F.struct(F.lit(y).alias("year"), F.lit(m).alias("month")) for y, m in months])
    return monthly.select("ticker").distinct().select("ticker", F.explode(at).alias("at")).select("ticker", "at.*")


def affected_years(monthly: DataFrame, months: list[Month], changed: DataFrame, rows_back: int = ROWS_BACK) -> list[int]:
    """Years of the months, and years with rows at most ``rows_back`` rows after a
    ticker's changed month.

    A ticker counts even where it has no bar left in a changed month: the rows
    that follow may have lost what they looked back at.
    """
    days = monthly.select("ticker", "year", "month", "trading_days")
    # One mark per ticker and changed month, placed after the month's own rows.
    marked = changed.select("ticker", "year", "month", F.lit(0).cast("bigint").alias("trading_days"), F.lit(True).alias("mark"))
    rows = days.withColumn("mark", F.lit(False)).unionByName(marked)
    order = Window.partitionBy("ticker").orderBy("year", "month", "mark").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.sum("trading_days").over(order)
    at_mark = F.last(F.when(F.col("mark"), F.col("seen")), ignorenulls=True).over(order)
    counted = rows.withColumn("seen", seen).withColumn("at_mark", at_mark)
    after = counted.where(~F.col("mark") & (F.col("seen") - F.col("trading_days") - F.col("at_mark") < rows_back))
    found = after.select("year").distinct().collect()
    return sorted({r.year for r in found} | {y for y, _ in months})


def context_rows(monthly: DataFrame, years: list[int], rows_back: int = ROWS_BACK) -> DataFrame:
    """(ticker, year, month) outside ``years`` that hold one of the ``rows_back``
    rows before a ticker's first row of one of them."""
    days = monthly.select("ticker", "year", "month", "trading_days").withColumn("mark", F.col("year").isin(years))
    order = Window.partitionBy("ticker").orderBy(F.col("year").desc(), F.col("month").desc()).rowsBetween(Window.unboundedPreceding, 0)
    counted = days.withColumn("seen", F.sum("trading_days").over(order)).withColumn(
        "at_mark", F.last(F.when(F.col("mark"), F.col("seen")), ignorenulls=True).over(order))
    return counted.where(~F.col("mark") & (F.col("seen") - F.col("trading_days") - F.col("at_mark") < rows_back)) \
        .select("ticker", "year", "month")


def daily_source(silver: DataFrame, years: list[int], context: DataFrame, context_months: list[Month]) -> DataFrame:
    """Silver rows of ``years`` and, from ``context_months`` only, those named in ``context``."""
    before = silver.where(_in_months(context_months)).join(context, ["ticker", "year", "month"], "left_semi")
    return silver.where(F.col("year").isin(years)).unionByName(before.select(silver.columns))


def refresh(lake: Lake, months: Iterable[Month], late: DataFrame | None = None) -> Refreshed:
    """Rebuild what depends on the bars of ``months`` as the bars layer has them now.

    Where the change is known to be some ``late`` bars, later years are rewritten
    for their tickers only; without it every ticker counts as changed.  The result equals a full build.  Safe to repeat: every step replaces whole
    partitions of its layer by what the layer before it holds.  Two things need
    a full build and raise or stay: a month that has lost all its clean bars
    (its partition would remain), and an exchange that has lost all bars of a
    ticker (``ticker_exchanges`` only gains pairs).
    """
    months = sorted(set(months))
    if not months:
        return Refreshed([], [], [], [])
    clean = layers.clean(lake.read("bars").where(_in_ranges(months, "trade_date")))
    emptied = sorted(set(_present(lake, "stock_prices", months)) - set(months_of(clean)))
    if emptied:
        raise ValueError(f"months without a clean bar left: {emptied}; rebuild the layers")

    _add_pairs(lake, clean)
    lake.write("stock_prices", layers.silver(clean), mode="partitions")
    silver = lake.read("stock_prices")
    lake.write("monthly_stock_performance", layers.monthly_performance(silver.where(_in_months(months))), mode="partitions")
    years = sorted({y for y, _ in months})
    lake.write("yearly_stock_performance", layers.yearly_performance(silver.where(F.col("year").isin(years))), mode="partitions")

    monthly = lake.read("monthly_stock_performance")
    daily_years = affected_years(monthly, months, changed_tickers(monthly, months, late))
    context = context_rows(monthly, daily_years)
    context_months = sorted((r.year, r.month) for r in context.select("year", "month").distinct().collect())
    source = daily_source(silver, daily_years, context, context_months)
    lake.write("daily_stock_metrics", layers.daily_metrics(source).where(F.col("year").isin(daily_years)), mode="partitions")
    return Refreshed(months, years, daily_years, context_months)


def _present(lake: Lake, layer: str, months: list[Month]) -> list[Month]:
    found = lake.read(layer).where(_in_months(months)).select("year", "month").distinct().collect()
    return [(r.year, r.month) for r in found]


def _add_pairs(lake: Lake, clean: DataFrame) -> None:
    """Add the (ticker, exchange) pairs of new bars to the bridge, if there are any."""
    held = lake.read("ticker_exchanges")
    new = layers.ticker_exchanges(clean).join(held, ["ticker", "exchange_id"], "left_anti")
    path = scratch_path(lake.spark, "pairs")
    new.write.parquet(path)
    new = lake.spark.read.schema(held.schema).parquet(path)
    if not new.isEmpty():
        new.coalesce(1).write.mode("append").parquet(lake.path("ticker_exchanges"))


def append_bars(lake: Lake, bars: DataFrame) -> list[Month]:
    """Add late bars to the bars layer; the months to refresh.

    Bars that are there already do no harm: silver keeps one per ticker and day.
    """
    bars.write.mode("append").partitionBy("exchange_id").parquet(lake.path("bars"))
    return months_of(bars)
