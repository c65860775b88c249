"""The one place that declares every input contract and layer table.

Text inputs (CSV, JSON, stream payloads) are always read with these declared
schemas, never inferred.  ``LAYER_TABLES`` drives table registration.

Fixed values: field names, order and types below are the reference's input
formats and table contracts, so results and marts stay interchangeable.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType,
)

# Bar CSV: positional columns, all read as strings and cast afterwards.
BAR_CSV = StructType([
    StructField("Date", StringType()),
    StructField("Low", StringType()),
    StructField("Open", StringType()),
    StructField("Volume", StringType()),
    StructField("High", StringType()),
    StructField("Close", StringType()),
    StructField("Adjusted Close", StringType()),
])

# Daily quote document (one multi-line JSON file per day).
QUOTE_JSON = StructType([
    StructField("symbol", StringType()),
    StructField("exchange", ArrayType(StringType())),
    StructField("quote", StructType([
        StructField("c", DoubleType()),
        StructField("d", DoubleType()),
        StructField("dp", DoubleType()),
        StructField("h", DoubleType()),
        StructField("l", DoubleType()),
        StructField("o", DoubleType()),
        StructField("pc", DoubleType()),
        StructField("t", LongType()),
    ])),
])

# One trade as carried in a message value.
TRADE = StructType([
    StructField("symbol", StringType()),
    StructField("price", DoubleType()),
    StructField("timestamp_ms", LongType()),
    StructField("volume", DoubleType()),
])

# Market-data provider envelope: many trades per message.
TRADE_ENVELOPE = StructType([
    StructField("type", StringType()),
    StructField("data", ArrayType(StructType([
        StructField("s", StringType()),
        StructField("p", DoubleType()),
        StructField("t", LongType()),
        StructField("v", DoubleType()),
    ]))),
])

# Layer tables: name -> (columns DDL, partition columns DDL).
LAYER_TABLES: dict[str, tuple[str, str]] = {
    "exchange_dim": ("exchange_id INT, exchange_name STRING", ""),
    "ticker_exchanges": ("ticker STRING, exchange_id INT", ""),
    "stock_prices": (
        "ticker STRING, trade_date DATE, quarter INT, day_of_week INT, open_price DOUBLE, "
        "high_price DOUBLE, low_price DOUBLE, close_price DOUBLE, adjusted_close_price DOUBLE, "
        "volume BIGINT, daily_range DOUBLE, daily_change DOUBLE, daily_change_pct DOUBLE",
        "year INT, month INT"),
    "daily_stock_metrics": (
        "ticker STRING, trade_date DATE, open_price DOUBLE, high_price DOUBLE, low_price DOUBLE, "
        "close_price DOUBLE, adjusted_close_price DOUBLE, volume BIGINT, daily_change_pct DOUBLE, "
        "prev_close_price DOUBLE, avg_volume_20d BIGINT, avg_volume_7d BIGINT, volume_ratio DOUBLE, "
        "is_volume_spike BOOLEAN, is_significant_drop BOOLEAN, rolling_volatility_30d DOUBLE, "
        "rolling_high_7d DOUBLE, rolling_low_7d DOUBLE",
        "year INT"),
    "monthly_stock_performance": (
        "ticker STRING, first_trade_date DATE, last_trade_date DATE, trading_days BIGINT, "
        "month_open_price DOUBLE, month_close_price DOUBLE, month_high_price DOUBLE, "
        "month_low_price DOUBLE, monthly_return_pct DOUBLE, total_volume BIGINT, "
        "avg_daily_volume BIGINT, avg_intraday_range DOUBLE, max_intraday_range DOUBLE, "
        "avg_intraday_range_pct DOUBLE",
        "year INT, month INT"),
    "yearly_stock_performance": (
        "ticker STRING, first_trade_date DATE, last_trade_date DATE, trading_days BIGINT, "
        "year_open_price DOUBLE, year_close_price DOUBLE, year_high_price DOUBLE, "
        "year_low_price DOUBLE, yearly_return_pct DOUBLE, total_volume BIGINT, "
        "avg_daily_volume BIGINT, avg_daily_return_pct DOUBLE, stddev_daily_return DOUBLE, "
        "positive_days BIGINT, negative_days BIGINT",
        "year INT"),
    "streaming_daily_quotes": (
        "symbol STRING, exchange ARRAY<STRING>, current_price DOUBLE, change DOUBLE, "
        "change_pct DOUBLE, high_price DOUBLE, low_price DOUBLE, open_price DOUBLE, "
        "prev_close DOUBLE, api_timestamp BIGINT",
        "quote_date STRING"),
    "streaming_7d_aggregates": (
        "symbol STRING, max_7d_high DOUBLE, min_7d_low DOUBLE, avg_prev_close DOUBLE, "
        "days_count INT",
        ""),
}

# Columns of the layers in the order the builds give them.
BAR_COLUMNS = ["ticker", "trade_date", "open_price", "high_price", "low_price", "close_price",
               "adjusted_close_price", "volume"]
SILVER_COLUMNS = ["ticker", "trade_date", "year", "month", "quarter", "day_of_week",
                  "open_price", "high_price", "low_price", "close_price", "adjusted_close_price",
                  "volume", "daily_range", "daily_change", "daily_change_pct"]
DAILY_COLUMNS = ["ticker", "trade_date", "year", "open_price", "high_price", "low_price",
                 "close_price", "adjusted_close_price", "volume", "daily_change_pct",
                 "prev_close_price", "avg_volume_20d", "avg_volume_7d", "volume_ratio",
                 "is_volume_spike", "is_significant_drop", "rolling_volatility_30d",
                 "rolling_high_7d", "rolling_low_7d"]

# Exported marts: question -> (table name, presentation order; "-" is descending).
MARTS: dict[str, tuple[str, list[str]]] = {
    "q01": ("q01_top_performers_by_exchange_year", ["exchange_id", "year", "return_rank"]),
    "q02": ("q02_year_over_year_return_change", ["ticker", "year"]),
    "q03": ("q03_biggest_monthly_drop_vs_average", ["year", "month"]),
    "q04": ("q04_largest_3month_recovery", ["-rolling_3month_recovery_pct"]),
    "q05": ("q05_cumulative_return_ranking", ["year", "month", "cumulative_rank"]),
    "q06": ("q06_consistent_exchange_outperformers", ["-years_outperformed", "ticker"]),
    "q07": ("q07_above_average_volatility_days", ["ticker", "trade_date"]),
    "q08": ("q08_volume_spike_next_day_direction", ["ticker", "trade_date"]),
    "q09": ("q09_intraday_volatility_percentile",
            ["year", "month", "exchange_id", "-volatility_percentile"]),
    "q10": ("q10_longest_positive_month_streaks", ["-consecutive_months", "ticker"]),
}

# Stream marts: question -> (table name, key columns).
STREAM_MARTS: dict[str, tuple[str, list[str]]] = {
    "sq1": ("sq1_price_volatility", ["window_start", "window_end", "symbol"]),
    "sq2": ("sq2_market_sentiment", ["window_start", "window_end", "exchange"]),
    "sq3": ("sq3_trade_frequency", ["window_start", "window_end", "symbol"]),
    "sq4": ("sq4_price_vs_7d", ["window_start", "window_end", "symbol"]),
    "sq5": ("sq5_vs_prev_close", ["window_start", "window_end", "symbol"]),
}
