"""Build the layer tables in order and answer the questions from them.

Each layer is written once and read back by the next, as a batch DAG would
run them: lineage is cut at every layer (a lost executor recomputes from
the last written layer, not from the raw inputs) and no step re-runs its
parents.

    bars (bronze) -> stock_prices (silver), ticker_exchanges, exchange_dim
    stock_prices  -> daily_stock_metrics, monthly_stock_performance,
                     yearly_stock_performance
    quotes        -> streaming_daily_quotes, streaming_7d_aggregates
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import layers, questions as q
from tidemark.schemas import LAYER_TABLES, MARTS
from tidemark.sources.sinks import run_exports, write_layer
from tidemark.streaming import questions as sq

# The raw bars are the one layer whose size follows the input volume, and their
# partition column has a handful of values: they are written as they come.
AS_THEY_COME = {"bars"}

# layer name -> partition columns
LAYOUT = {
    "bars": ["exchange_id"],
    "exchange_dim": [],
    "ticker_exchanges": [],
    "stock_prices": ["year", "month"],
    "daily_stock_metrics": ["year"],
    "monthly_stock_performance": ["year", "month"],
    "yearly_stock_performance": ["year"],
    "streaming_daily_quotes": ["quote_date"],
    "streaming_7d_aggregates": [],
}


class Lake:
    """Layer tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str, max_records_per_file: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.max_records_per_file = max_records_per_file

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, name: str, df: DataFrame, mode: str = "replace") -> None:
        write_layer(df, self.path(name), partition_by=LAYOUT[name], mode=mode,
                    rebalance=name not in AS_THEY_COME,
                    max_records_per_file=self.max_records_per_file)

    def read(self, name: str) -> DataFrame:
        """A layer with its declared types (a partition column keeps the type of
        the contract, not the one its folder names look like)."""
        reader = self.spark.read
        if name in LAYER_TABLES:
            columns, parts = LAYER_TABLES[name]
            reader = reader.schema(columns + (", " + parts if parts else ""))
        return reader.parquet(self.path(name))


def build_steps(lake: Lake, bars: Callable[[], DataFrame], dim: Callable[[], DataFrame],
                quotes: Callable[[], DataFrame]) -> list[tuple[str, Callable[[], None]]]:
    """The layer builds in dependency order, as (name, action) pairs."""
    return [
        ("bars", lambda: lake.write("bars", bars())),
        ("exchange_dim", lambda: lake.write("exchange_dim", dim())),
        ("ticker_exchanges", lambda: lake.write(
            "ticker_exchanges", layers.ticker_exchanges(layers.clean(lake.read("bars"))))),
        ("stock_prices", lambda: lake.write(
            "stock_prices", layers.silver(layers.clean(lake.read("bars"))))),
        ("daily_stock_metrics", lambda: lake.write(
            "daily_stock_metrics", layers.daily_metrics(lake.read("stock_prices")))),
        ("monthly_stock_performance", lambda: lake.write(
            "monthly_stock_performance", layers.monthly_performance(lake.read("stock_prices")))),
        ("yearly_stock_performance", lambda: lake.write(
            "yearly_stock_performance", layers.yearly_performance(lake.read("stock_prices")))),
        ("streaming_daily_quotes", lambda: lake.write("streaming_daily_quotes", quotes())),
        ("streaming_7d_aggregates", lambda: lake.write(
            "streaming_7d_aggregates",
            layers.quote_baselines(lake.read("streaming_daily_quotes")))),
    ]


def file_sources(spark: SparkSession, csv_root: str, quotes_glob: str,
                 min_date: str | None = "1993-01-01") -> dict[str, Callable[[], DataFrame]]:
    """``build_steps`` inputs from the original file formats: per-ticker bar
    CSVs under ``<csv_root>/<exchange>/csv/`` and daily quote documents."""
    from tidemark.sources import files

    return {
        "bars": lambda: files.bars_from_bronze(
            files.read_bars_csv(spark, csv_root, min_date=min_date), files.exchange_dim(spark)),
        "dim": lambda: files.exchange_dim(spark),
        "quotes": lambda: files.read_quotes_json(spark, quotes_glob),
    }


def question_frames(lake: Lake, trades: DataFrame | None) -> dict[str, Callable[[], DataFrame]]:
    """The ten batch questions and the five stream questions (batch form),
    each reading the written layers."""
    r = lake.read
    return {
        "q01": lambda: q.top_n_per_exchange_year(r("yearly_stock_performance"),
                                                 r("ticker_exchanges"), r("exchange_dim")),
        "q02": lambda: q.period_over_period_change(r("yearly_stock_performance")),
        "q03": lambda: q.worst_vs_own_mean(r("monthly_stock_performance")),
        "q04": lambda: q.recovery_after_drop(r("monthly_stock_performance")),
        "q05": lambda: q.cumulative_rank(r("monthly_stock_performance")),
        "q06": lambda: q.outperformance_rate(r("yearly_stock_performance"),
                                             r("ticker_exchanges"), r("exchange_dim")),
        "q07": lambda: q.above_period_mean(r("daily_stock_metrics")),
        "q08": lambda: q.spike_followup(r("daily_stock_metrics")),
        "q09": lambda: q.percentile_in_group(r("monthly_stock_performance"),
                                             r("ticker_exchanges"), r("exchange_dim")),
        "q10": lambda: q.positive_streaks(r("monthly_stock_performance")),
        "sq1": lambda: sq.price_volatility(trades),
        "sq2": lambda: sq.market_sentiment(
            trades, layers.latest_snapshot(r("streaming_daily_quotes"))),
        "sq3": lambda: sq.trade_frequency(trades),
        "sq4": lambda: sq.price_vs_range(trades, r("streaming_7d_aggregates")),
        "sq5": lambda: sq.vs_prev_close(
            trades, layers.latest_snapshot(r("streaming_daily_quotes"))),
    }


def export_questions(lake: Lake, sink, marts=None) -> dict[str, int]:
    """Answer the batch questions from the lake and hand each result, in its
    presentation order, to ``sink(df, mart name)`` (Parquet or JDBC, see
    ``sources.sinks``); returns the row counts observed during the writes.

    ``marts`` maps a question to (mart name, order), by default the ten of
    ``schemas.MARTS``.  Results are reports; nothing partitioned is sorted.
    """
    frames = question_frames(lake, trades=None)
    return run_exports({name: q.present(frames[question](), *order)
                        for question, (name, order) in (marts or MARTS).items()}, sink)


def timed(action: Callable[[], object]) -> float:
    t0 = time.perf_counter()
    action()
    return time.perf_counter() - t0
