"""Refreshing some months equals a full build and reads and writes only what it must."""
import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental as inc
from tidemark.plans import layers
from tidemark.plans.lake import Lake, build_steps

BARS = ("ticker string, exchange_id int, exchange_name string, trade_date date, open_price double, high_price double, "
        "low_price double, close_price double, volume bigint, adjusted_close_price double")
LAYERS = ["ticker_exchanges", "stock_prices", "daily_stock_metrics", "monthly_stock_performance", "yearly_stock_performance"]


def bar(ticker, day, price, exchange=1):
    return (ticker, exchange, f"x{exchange}", day, price, price + 1, price - 1, price + .25, int(price * 10), price)


def history(seed=1):
    """A busy ticker, a weekly one, one with a few days a year, one that begins late and one that ends early."""
    rng = random.Random(seed)
    rows = []
    for k in range(0, 365 * 3):
        day = dt.date(2001, 1, 1) + dt.timedelta(days=k)
        if day.weekday() < 5:
            rows.append(bar("BUSY", day, 20 + rng.random()))
        if day.weekday() == 2:
            rows.append(bar("WEEKLY", day, 10 + rng.random(), 2))
        if k % 97 == 5:
            rows.append(bar("RARE", day, 5 + rng.random()))
        if day > dt.date(2002, 11, 15):
            rows.append(bar("LATE", day, 7 + rng.random()))
        if day < dt.date(2002, 2, 10):
            rows.append(bar("EARLY", day, 9 + rng.random()))
    return rows


def built(spark, root, rows):
    lake = Lake(spark, str(root))
    bars = spark.createDataFrame(rows, BARS)
    for name, action in build_steps(lake, lambda: bars, lambda: bars.select("exchange_id", "exchange_name").distinct(), lambda: None):
        if name in ["bars", *LAYERS]:
            action()
    return lake


def contents(lake):
    out = {}
    for name in LAYERS:
        df = lake.read(name)
        # Means and deviations may differ in their last bits by the order of summation.
        out[name] = sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
    return out


def files(lake, name):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(lake.path(name)) for f in names if f.endswith(".parquet")}


def years_changed(lake, name, before):
    after = files(lake, name)
    return sorted({int(re.search(r"year=(\d+)", p).group(1)) for p in before.keys() ^ after.keys()})


CASES = {
    "december reaches into the next year": [(2002, 12)],
    "two apart": [(2001, 1), (2003, 3)],
}


@pytest.mark.parametrize("case", CASES)
def test_late_months(spark, tmp_path, case):
    months, rows = CASES[case], history()
    late = [r for r in rows if (r[3].year, r[3].month) in months]
    full = built(spark, tmp_path / "full", rows)
    lake = built(spark, tmp_path / "lake", [r for r in rows if r not in late])
    before = {name: files(lake, name) for name in LAYERS[1:]}
    bars = spark.createDataFrame(late, BARS)
    found = inc.append_bars(lake, bars)
    assert found == months
    done = inc.refresh(lake, found, bars)
    assert contents(lake) == contents(full)
    assert years_changed(lake, "daily_stock_metrics", before["daily_stock_metrics"]) == done.daily_years
    assert years_changed(lake, "yearly_stock_performance", before["yearly_stock_performance"]) == sorted({y for y, _ in months})
    assert inc.refresh(lake, found, bars) == done and contents(lake) == contents(full)  # safe to repeat


def test_a_month_that_loses_bars(spark, tmp_path):
    """The rare ticker's bar of the month goes: its later rows, years after, look back at others."""
    rows = history()
    gone = next(r for r in rows if r[0] == "RARE" and r[3].year == 2002)
    month = (gone[3].year, gone[3].month)
    lake = built(spark, tmp_path / "lake", rows)
    lake.write("bars", spark.createDataFrame([r for r in rows if r != gone], BARS))
    done = inc.refresh(lake, [month])
    assert contents(lake) == contents(built(spark, tmp_path / "full", [r for r in rows if r != gone]))
    assert done.daily_years == [2002, 2003]


def test_only_changed_tickers_count(spark, tmp_path):
    """A late bar of the busy ticker does not touch the years that the rare one's frames reach into."""
    rows = history()
    lake = built(spark, tmp_path / "lake", rows)
    late = spark.createDataFrame([bar("BUSY", dt.date(2002, 5, 4), 30.)], BARS)
    done = inc.refresh(lake, inc.append_bars(lake, late), late)
    assert done.daily_years == [2002]
    assert contents(lake) == contents(built(spark, tmp_path / "full", rows + [bar("BUSY", dt.date(2002, 5, 4), 30.)]))


def test_only_near_months_are_read(spark, tmp_path):
    rows = [r for r in history() if r[0] in ("BUSY", "WEEKLY")]
    lake = built(spark, tmp_path / "lake", rows)
    done = inc.refresh(lake, [(2003, 3)])
    assert done.daily_years == [2003]
    assert done.context == [(2002, m) for m in range(6, 13)]  # 29 weeks back for the weekly ticker
    monthly, silver = lake.read("monthly_stock_performance"), lake.read("stock_prices")
    context = inc.context_rows(monthly, done.daily_years)
    assert {(r.ticker, r.year, r.month) for r in context.collect() if r.ticker == "BUSY"} == {("BUSY", 2002, 11), ("BUSY", 2002, 12)}
    source = inc.daily_source(silver, done.daily_years, context, done.context)
    plan = source._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*year", plan)) >= 2
    opened = inc.daily_source(silver.withColumn("file", F.input_file_name()), done.daily_years, context, done.context)
    read = {re.search(r"year=(\d+)/month=(\d+)", r.file).groups() for r in opened.select("file").distinct().collect()}
    assert {(int(y), int(m)) for y, m in read} == {(2003, m) for m in range(1, 13)} | set(done.context)


def test_nothing_and_emptied_months(spark, tmp_path):
    rows = [r for r in history() if r[3] < dt.date(2001, 4, 1)]
    lake = built(spark, tmp_path / "lake", rows)
    before = contents(lake)
    assert inc.refresh(lake, []).months == []
    assert inc.refresh(lake, [(1990, 1)]).months == [(1990, 1)]  # a month without bars changes nothing
    assert contents(lake) == before
    lake.write("bars", spark.createDataFrame([r for r in rows if r[3].month != 2], BARS))
    with pytest.raises(ValueError):
        inc.refresh(lake, [(2001, 2)])
    assert contents(lake) == before


def test_new_pairs_are_added_once(spark, tmp_path):
    rows = [r for r in history() if r[3] < dt.date(2001, 3, 1)]
    lake = built(spark, tmp_path / "lake", rows)
    extra = [bar("BUSY", dt.date(2001, 2, 1), 30., 3), bar("NEW", dt.date(2001, 2, 1), 30., 3)]
    months = inc.append_bars(lake, spark.createDataFrame(extra, BARS))
    inc.refresh(lake, months)
    inc.refresh(lake, months)
    assert contents(lake) == contents(built(spark, tmp_path / "full", rows + extra))
    assert layers.ticker_exchanges(layers.clean(lake.read("bars"))).count() == lake.read("ticker_exchanges").count()
