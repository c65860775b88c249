"""Named compositions over the provided test tables: every layer, question,
window/aggregate operator in isolation, and the stream questions' batch twins.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame over the whole
tables.  Each call builds its own plan from the raw tables so Catalyst sees
(and prunes/pushes down through) the full lineage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import windows as win
from tidemark.operators.quality import bar_rules, derive_bar_columns, quality_report
from tidemark.plans import incremental, layers, questions as q
from tidemark.sources import files, fixtures, sinks
from tidemark.sources.stream import decode_trades, flatten_trade_envelopes, trade_envelopes, \
    trade_payloads
from tidemark.plans.lake import Lake
from tidemark.session import scratch_path
from tidemark.streaming import questions as sq
from tidemark.streaming.runner import rocksdb_state, start_append
from tidemark.streaming.sinks import fold_windows, read_latest_windows, upsert_windows


class Layers:
    """Lazy layer frames over one fixture directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def bars(self) -> DataFrame:
        return fixtures.bars(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return layers.clean(self.bars)

    @cached_property
    def silver(self) -> DataFrame:
        return layers.silver(self.clean)

    @cached_property
    def bridge(self) -> DataFrame:
        return layers.ticker_exchanges(self.clean)

    @cached_property
    def dim(self) -> DataFrame:
        return fixtures.exchange_dim(self.spark, self.sf_dir)

    @cached_property
    def daily(self) -> DataFrame:
        return layers.daily_metrics(self.silver)

    @cached_property
    def monthly(self) -> DataFrame:
        return layers.monthly_performance(self.silver)

    @cached_property
    def yearly(self) -> DataFrame:
        return layers.yearly_performance(self.silver)

    @cached_property
    def trades(self) -> DataFrame:
        return fixtures.trades(self.spark, self.sf_dir)

    @cached_property
    def quotes(self) -> DataFrame:
        return fixtures.daily_quotes(self.spark, self.sf_dir)

    @cached_property
    def snapshot(self) -> DataFrame:
        return layers.latest_snapshot(self.quotes)

    @cached_property
    def baselines(self) -> DataFrame:
        return layers.quote_baselines(self.quotes)


def round_columns(df: DataFrame, names, digits: int = 6) -> DataFrame:
    """Round the named double columns (for comparing sums/means whose last
    bits depend on the summation order)."""
    return df.withColumns({n: F.round(n, digits) for n in names})


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Layers], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Layers(spark, sf_dir))
        return fn
    return deco


# ------------------------------------------------------------------ layers

@register("bars")
def _bars(L: Layers):
    return L.bars


@register("bars_hash_order")
def _bars_lead(L: Layers):
    return fixtures.bars(L.spark, L.sf_dir, order="lead")


@register("bar_quality_report")
def _quality(L: Layers):
    return quality_report(L.bars, bar_rules())


@register("bar_quality_filter")
def _clean(L: Layers):
    return L.clean


@register("bar_dedupe")
def _dedupe(L: Layers):
    return layers.dedupe_bars(L.clean)


@register("bar_derivations")
def _derivations(L: Layers):
    return derive_bar_columns(layers.dedupe_bars(L.clean).drop("exchange_id")).select(
        "ticker", "trade_date", "daily_range", "daily_change", "daily_change_pct")


@register("silver")
def _silver(L: Layers):
    return L.silver


@register("exchange_dim")
def _dim(L: Layers):
    return L.dim


@register("ticker_exchanges")
def _bridge(L: Layers):
    return L.bridge


@register("ticker_exchanges_kept")
def _bridge_kept(L: Layers):
    return layers.ticker_exchanges(L.clean, membership="kept")


@register("daily_metrics")
def _daily(L: Layers):
    return round_columns(L.daily, ["rolling_volatility_30d"])


@register("monthly_performance")
def _monthly(L: Layers):
    return round_columns(L.monthly, ["avg_intraday_range", "avg_intraday_range_pct"])


@register("yearly_performance")
def _yearly(L: Layers):
    return round_columns(L.yearly, ["avg_daily_return_pct", "stddev_daily_return"])


@register("daily_quotes")
def _quotes(L: Layers):
    return L.quotes


@register("quote_baselines")
def _baselines(L: Layers):
    return round_columns(L.baselines, ["avg_prev_close"])


@register("quote_baselines_all_days")
def _baselines_all(L: Layers):
    return round_columns(layers.quote_baselines(L.quotes, days=None), ["avg_prev_close"])


@register("latest_snapshot")
def _snapshot(L: Layers):
    return L.snapshot


# --------------------------------------------------------------- questions

@register("q01_top_n")
def _q01(L: Layers):
    return q.top_n_per_exchange_year(L.yearly, L.bridge, L.dim)


@register("q02_period_change")
def _q02(L: Layers):
    return q.period_over_period_change(L.yearly)


@register("q02_adjacent")
def _q02_adj(L: Layers):
    return q.period_over_period_change(L.yearly, require_adjacent=True)


@register("q03_worst_vs_mean")
def _q03(L: Layers):
    return q.worst_vs_own_mean(L.monthly)


@register("q04_recovery")
def _q04(L: Layers):
    return q.recovery_after_drop(L.monthly)


@register("q04_compound")
def _q04c(L: Layers):
    return q.recovery_after_drop(L.monthly, compound=True)


@register("q05_cumulative_rank")
def _q05(L: Layers):
    return q.cumulative_rank(L.monthly)


@register("q05_compound")
def _q05c(L: Layers):
    return q.cumulative_rank(L.monthly, compound=True)


@register("q06_outperformance")
def _q06(L: Layers):
    return q.outperformance_rate(L.yearly, L.bridge, L.dim)


@register("q07_above_mean")
def _q07(L: Layers):
    return q.above_period_mean(L.daily)


@register("q07_rounded")
def _q07r(L: Layers):
    return q.above_period_mean(L.daily, filter_digits=6)


@register("q06_any_year")
def _q06any(L: Layers):
    return q.outperformance_rate(L.yearly, L.bridge, L.dim, min_years=1)


def _with_gaps(df: DataFrame) -> DataFrame:
    """Periods in which a ticker trades less than its own mean left out, so that
    neighbours are not adjacent."""
    own = Window.partitionBy("ticker")
    counted = df.withColumns({"_n": F.count(F.lit(1)).over(own), "_all": F.sum("total_volume").over(own)})
    return counted.filter(F.col("total_volume") * F.col("_n") >= F.col("_all")).drop("_n", "_all")


@register("q02_gaps")
def _q02g(L: Layers):
    return q.period_over_period_change(_with_gaps(L.yearly))


@register("q02_gaps_adjacent")
def _q02ga(L: Layers):
    return q.period_over_period_change(_with_gaps(L.yearly), require_adjacent=True)


@register("q10_gaps")
def _q10g(L: Layers):
    return q.positive_streaks(_with_gaps(L.monthly), min_len=2)


@register("q10_gaps_adjacent")
def _q10ga(L: Layers):
    return q.positive_streaks(_with_gaps(L.monthly), min_len=2, require_adjacent=True)


@register("q05_compound_total_loss")
def _q05loss(L: Layers):
    ret = F.when((F.col("month") == 6) & (F.col("year") % 2 == 0), -100.0).otherwise(F.col("monthly_return_pct"))
    return q.cumulative_rank(L.monthly.withColumn("monthly_return_pct", ret), compound=True)


@register("q08_spike_followup")
def _q08(L: Layers):
    return q.spike_followup(L.daily)


@register("q08_trading_day")
def _q08t(L: Layers):
    return q.spike_followup(L.daily, next="trading_day")


@register("q09_percentile")
def _q09(L: Layers):
    return q.percentile_in_group(L.monthly, L.bridge, L.dim)


@register("q10_streaks")
def _q10(L: Layers):
    return q.positive_streaks(L.monthly)


@register("q10_independent_bounds")
def _q10i(L: Layers):
    return q.positive_streaks(L.monthly, independent_bounds=True)


@register("q10_adjacent")
def _q10a(L: Layers):
    return q.positive_streaks(L.monthly, require_adjacent=True)


# ------------------------------------------------- window operators alone

def _monthly_returns(L: Layers) -> DataFrame:
    return L.monthly.filter(F.col("monthly_return_pct").isNotNull()).select(
        "ticker", "year", "month", "monthly_return_pct")


@register("win_lag")
def _win_lag(L: Layers):
    return win.lag_lead(L.silver.select("ticker", "trade_date", "close_price"),
                        ["ticker"], ["trade_date"], "close_price", name="prev_close_price")


@register("win_lag_default")
def _win_lag_default(L: Layers):
    return win.lag_lead(L.silver.select("ticker", "trade_date", "volume"), ["ticker"], ["trade_date"],
                        "volume", offset=5, default="volume", name="volume_5_before")


@register("win_row_number")
def _win_row_number(L: Layers):
    return win.rank_in_group(L.silver.select("ticker", "year", "trade_date", "volume"), ["ticker", "year"],
                             [F.col("volume").desc(), F.col("trade_date").asc()], method="row_number", name="volume_place")


@register("win_lead")
def _win_lead(L: Layers):
    return win.lag_lead(L.silver.select("ticker", "trade_date", "daily_change_pct"),
                        ["ticker"], ["trade_date"], "daily_change_pct", offset=-1,
                        name="next_change_pct")


@register("win_rank")
def _win_rank(L: Layers):
    return win.rank_in_group(_monthly_returns(L), ["year", "month"],
                             [F.col("monthly_return_pct").desc()], name="return_rank")


@register("win_percent_rank")
def _win_prank(L: Layers):
    df = win.rank_in_group(_monthly_returns(L), ["year", "month"],
                           [F.col("monthly_return_pct").asc()], method="percent_rank",
                           name="pct_rank")
    return round_columns(df, ["pct_rank"])


@register("win_rolling_mean_excl")
def _win_mean_excl(L: Layers):
    return win.trailing(L.silver.select("ticker", "trade_date", "volume"), ["ticker"],
                        ["trade_date"], "volume", "avg", -20, -1, name="avg_volume_prev20")


@register("win_rolling_extrema")
def _win_extrema(L: Layers):
    df = L.silver.select("ticker", "trade_date", "high_price", "low_price")
    df = win.trailing(df, ["ticker"], ["trade_date"], "high_price", "max", -6, name="high_7")
    return win.trailing(df, ["ticker"], ["trade_date"], "low_price", "min", -6, name="low_7")


@register("win_rolling_stddev")
def _win_stddev(L: Layers):
    df = win.trailing(L.silver.select("ticker", "trade_date", "daily_change_pct"), ["ticker"],
                      ["trade_date"], "daily_change_pct", "stddev", -29, name="vol_30")
    return round_columns(df, ["vol_30"])


@register("win_rolling_sum")
def _win_sum(L: Layers):
    df = win.trailing(_monthly_returns(L), ["ticker"], ["year", "month"],
                      "monthly_return_pct", "sum", -2, name="sum_3")
    return round_columns(df, ["sum_3"])


@register("win_running_sum")
def _win_running(L: Layers):
    df = win.running_sum(_monthly_returns(L), ["ticker", "year"], ["month"],
                         "monthly_return_pct", name="ytd_return")
    return round_columns(df, ["ytd_return"])


@register("win_partition_mean")
def _win_mean(L: Layers):
    df = win.vs_group_mean(_monthly_returns(L), ["ticker"], "monthly_return_pct",
                           "mean_return", "vs_mean")
    return round_columns(df, ["mean_return", "vs_mean"])


@register("win_islands")
def _win_islands(L: Layers):
    return win.streaks(_monthly_returns(L), ["ticker"], ["year", "month"],
                       F.col("monthly_return_pct") > 0, 1)


# ------------------------------------------------------------- aggregates

@register("agg_first_last")
def _agg_first_last(L: Layers):
    return agg.first_last(L.silver, ["ticker", "year", "quarter"], "trade_date",
                          {"quarter_open": "open_price"}, {"quarter_close": "close_price"})


@register("agg_conditional")
def _agg_cond(L: Layers):
    pct = F.col("daily_change_pct")
    return L.silver.groupBy("ticker", "year").agg(
        agg.count_where(pct > 0).alias("up_days"),
        agg.count_where(pct < 0).alias("down_days"),
        F.round(agg.mean_where(pct, pct > 0), 6).alias("avg_up_pct"))


@register("agg_distinct_days")
def _agg_distinct(L: Layers):
    return L.quotes.groupBy("symbol").agg(
        F.count_distinct("quote_date").cast("int").alias("days_count"))


# ---------------------------------------------------------- stream twins

@register("trade_decode")
def _decode(L: Layers):
    return decode_trades(trade_payloads(L.trades))


@register("trade_envelope_flatten")
def _flatten(L: Layers):
    return flatten_trade_envelopes(trade_envelopes(L.trades))


@register("sq1_price_volatility")
def _sq1(L: Layers):
    return sq.price_volatility(L.trades)


@register("sq2_market_sentiment")
def _sq2(L: Layers):
    return sq.market_sentiment(L.trades, L.snapshot)


@register("sq3_trade_frequency")
def _sq3(L: Layers):
    return sq.trade_frequency(L.trades, baseline=1)


@register("sq3_default_baseline")
def _sq3d(L: Layers):
    return sq.trade_frequency(L.trades)


@register("sq3_symbol_baseline")
def _sq3b(L: Layers):
    return sq.trade_frequency(L.trades, baseline=sq.window_count_baseline(L.trades), factor=1.5)


@register("sq4_price_vs_range")
def _sq4(L: Layers):
    return sq.price_vs_range(L.trades, L.baselines)


@register("sq5_vs_prev_close")
def _sq5(L: Layers):
    return sq.vs_prev_close(L.trades, L.snapshot)


# ------------------------------------------- ingest, dirty rows, layer writes

@register("bars_text_ingest")
def _bars_text(L: Layers):
    return fixtures.read_bar_text(fixtures.bar_text(L.bars), "1994-01-01").drop("ingestion_timestamp")


@register("bar_dedupe_unknown_exchange")
def _dedupe_unknown(L: Layers):
    lost = F.when(F.col("exchange_id") != 0, F.col("exchange_id"))
    return layers.dedupe_bars(L.clean.withColumn("exchange_id", lost))


@register("dirty_bar_quality_report")
def _dirty_report(L: Layers):
    return quality_report(fixtures.dirty_bars(L.bars), bar_rules())


@register("dirty_bar_quality_filter")
def _dirty_bars(L: Layers):
    return layers.clean(fixtures.dirty_bars(L.bars), min_date="1993-06-01")


@register("dirty_quotes")
def _dirty_quotes(L: Layers):
    return layers.flatten_quotes(fixtures.dirty_quotes(L.quotes))


@register("sq1_dirty_trades")
def _sq1_dirty(L: Layers):
    return sq.price_volatility(fixtures.dirty_trades(L.trades))


@register("sq2_dirty_snapshot")
def _sq2_dirty(L: Layers):
    return sq.market_sentiment(L.trades, fixtures.dirty_snapshot(L.snapshot))


@register("sq5_dirty_snapshot")
def _sq5_dirty(L: Layers):
    return sq.vs_prev_close(L.trades, fixtures.dirty_snapshot(L.snapshot))


def _lake(L: Layers, name: str) -> Lake:
    return Lake(L.spark, scratch_path(L.spark, name))


@register("layer_rebuild_shrinks")
def _rebuild(L: Layers):
    lake = _lake(L, "rebuild")
    lake.write("yearly_stock_performance", L.yearly)
    lake.write("yearly_stock_performance", L.yearly.filter("year % 2 = 0"))
    return round_columns(lake.read("yearly_stock_performance"), ["avg_daily_return_pct", "stddev_daily_return"])


@register("layer_roundtrip_quotes")
def _roundtrip(L: Layers):
    lake = _lake(L, "roundtrip")
    lake.write("streaming_daily_quotes", L.quotes)
    return lake.read("streaming_daily_quotes")


def _late_month(L: Layers, name: str) -> Lake:
    """A lake built without its busiest month, which then comes late."""
    lake, bars = _lake(L, name), L.bars
    busiest = bars.groupBy(F.date_trunc("month", "trade_date").alias("m")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "m").first()["m"]
    late = F.date_trunc("month", "trade_date") == F.lit(busiest)
    lake.write("bars", bars.where(~late))
    clean = layers.clean(lake.read("bars"))
    lake.write("ticker_exchanges", layers.ticker_exchanges(clean))
    lake.write("stock_prices", layers.silver(clean))
    for layer, build in (("daily_stock_metrics", layers.daily_metrics), ("monthly_stock_performance", layers.monthly_performance),
                         ("yearly_stock_performance", layers.yearly_performance)):
        lake.write(layer, build(lake.read("stock_prices")))
    incremental.refresh(lake, incremental.append_bars(lake, bars.where(late)), bars.where(late))
    return lake


@register("daily_metrics_incremental")
def _daily_incremental(L: Layers):
    return round_columns(_late_month(L, "late").read("daily_stock_metrics"), ["rolling_volatility_30d"])


@register("yearly_performance_incremental")
def _yearly_incremental(L: Layers):
    return round_columns(_late_month(L, "late").read("yearly_stock_performance"), ["avg_daily_return_pct", "stddev_daily_return"])


@register("bars_from_files")
def _bars_files(L: Layers):
    """Ticker and exchange come from percent-encoded paths; one exchange has no
    folder, another is missing in the dimension."""
    root = scratch_path(L.spark, "bar-files")
    names = [r.exchange_name for r in L.dim.collect()]
    fixtures.write_bar_files(L.bars.where("exchange_name <> 'AFRICA'"), root)
    bronze = files.read_bars_csv(L.spark, root, exchanges=names)
    return files.bars_from_bronze(bronze, L.dim.where("exchange_name <> 'ASIA'"))


@register("quotes_from_files")
def _quotes_files(L: Layers):
    root = scratch_path(L.spark, "quote-files")
    fixtures.write_quote_files(L.quotes, root)
    return files.read_quotes_json(L.spark, f"{root}/*/quotes.json")


@register("q02_from_catalog")
def _q02_catalog(L: Layers):
    """Registered tables with discovered partitions; the question reads some of them."""
    lake = _lake(L, "catalog")
    lake.write("yearly_stock_performance", L.yearly)
    database = f"tidemark_{uuid.uuid4().hex[:12]}"
    sinks.register_tables(L.spark, lake.root, database=database, names=["yearly_stock_performance"])
    return q.period_over_period_change(L.spark.table(f"{database}.yearly_stock_performance").where("year >= 1995"))


def _exported(L: Layers, frame: DataFrame, *order: str) -> DataFrame:
    """A result in its exported order, with the row count observed while it was written."""
    root = scratch_path(L.spark, "marts")
    counts = sinks.run_exports({"report": q.present(frame, *order)}, sinks.parquet_sink(root))
    return sinks.read_in_order(L.spark, f"{root}/report").withColumn("exported_rows", F.lit(counts["report"]).cast("bigint"))


@register("q02_exported")
def _q02_exported(L: Layers):
    return _exported(L, q.period_over_period_change(L.yearly), "ticker", "year")


@register("q05_exported")
def _q05_exported(L: Layers):
    return _exported(L, q.cumulative_rank(L.monthly), "year", "month", "cumulative_rank", "-ticker")


# ----------------------------------------------- window sinks and stream runs

@register("windows_after_restart")
def _restart(L: Layers):
    """A first run left stale counts for one half of the windows and right ones
    for the other; a second run, with a new checkpoint, rewrote the stale half."""
    path, rows = scratch_path(L.spark, "restart"), sq.trade_frequency(L.trades, baseline=1)
    early = F.minute("window_start") < 30
    old = upsert_windows(path, "first")
    old(rows.limit(0), 0)
    old(rows.withColumn("trade_count", F.when(early, F.lit(0).cast("bigint")).otherwise(F.col("trade_count"))), 7)
    upsert_windows(path, "second")(rows.filter(early), 0)
    return read_latest_windows(L.spark, path, "sq3")


@register("windows_latest_sq2")
def _latest_sq2(L: Layers):
    path, rows = scratch_path(L.spark, "latest"), sq.market_sentiment(L.trades, L.snapshot)
    write = upsert_windows(path, "only")
    write(rows.withColumn("rising_count", F.lit(-1).cast("bigint")), 0)
    write(rows, 1)
    return read_latest_windows(L.spark, path, "sq2")


@register("windows_compacted")
def _compacted(L: Layers):
    """Six batches, of which one is replayed and some hold counts that a later one
    corrects, folded twice while they come in."""
    path, rows = scratch_path(L.spark, "folded"), sq.trade_frequency(L.trades, baseline=1)
    wrong = rows.withColumn("trade_count", F.lit(-1).cast("bigint"))
    early, write = F.minute("window_start") < 30, upsert_windows(path, "only")
    write(wrong.filter(early), 0)
    write(wrong.filter(~early), 1)
    write(rows.filter(early), 2)
    fold_windows(L.spark, path, "sq3")
    write(rows.filter(early), 2)
    write(wrong.filter(~early & (F.hour("window_start") < 12)), 3)
    write(rows.filter(~early & (F.hour("window_start") < 12)), 4)
    fold_windows(L.spark, path, "sq3")
    write(rows.filter(~early & (F.hour("window_start") >= 12)), 5)
    return read_latest_windows(L.spark, path, "sq3")


def _replayed(L: Layers, name: str, question) -> DataFrame:
    return read_latest_windows(L.spark, fixtures.replay(L.spark, L.trades, question, scratch_path(L.spark, name)), name)


@register("sq1_stream")
def _sq1_stream(L: Layers):
    return _replayed(L, "sq1", sq.price_volatility)


@register("sq2_stream")
def _sq2_stream(L: Layers):
    return _replayed(L, "sq2", lambda t: sq.market_sentiment(t, L.snapshot))


@register("sq3_stream")
def _sq3_stream(L: Layers):
    return _replayed(L, "sq3", lambda t: sq.trade_frequency(t, baseline=1))


@register("sq4_stream")
def _sq4_stream(L: Layers):
    return _replayed(L, "sq4", lambda t: sq.price_vs_range(t, L.baselines))


@register("sq5_stream")
def _sq5_stream(L: Layers):
    return _replayed(L, "sq5", lambda t: sq.vs_prev_close(t, L.snapshot))


def _closed(L: Layers, name: str, question, snapshots: DataFrame | None = None) -> DataFrame:
    """Windows that an append-mode file sink has after three runs over one checkpoint."""
    with rocksdb_state(L.spark):
        return L.spark.read.parquet(fixtures.replay(L.spark, L.trades, question, scratch_path(L.spark, name),
                                                    start=start_append, snapshots=snapshots))


@register("sq1_closed_stream")
def _sq1_closed(L: Layers):
    return _closed(L, "sq1", sq.price_volatility)


@register("sq2_closed_stream")
def _sq2_closed(L: Layers):
    return _closed(L, "sq2", lambda t: sq.market_sentiment(t, L.snapshot, emit="closed"))


@register("sq2_refreshed")
def _sq2_refreshed(L: Layers):
    return sq.market_sentiment_as_of(L.trades, fixtures.daily_snapshots(L.quotes))


@register("sq2_refreshed_stream")
def _sq2_refreshed_stream(L: Layers):
    return _closed(L, "sq2", sq.market_sentiment_as_of, fixtures.daily_snapshots(L.quotes))
