"""The five trade-stream questions.

Each function takes a trades frame (symbol, price, event_time) that may be a
streaming or a batch frame and returns the per-window result.  On a stream
the window aggregation is stateful (watermarked state store) and the
post-aggregation projection runs inside the streaming plan; the static
enrichment (snapshot, 7-day extremes) is a stream-static join.

Windows are tumbling; all aggregates are algebraic (count, avg, stddev), so
map-side partial aggregation bounds the shuffle per (window, key) no matter
how many trades a hot symbol has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import TimestampNTZType

from tidemark import constants as C
from tidemark.functions.expr import (
    direction, instant_to_ntz, ntz_to_instant, pct_above, pct_below, range_position,
)
from tidemark.operators.quality import apply_rules, trade_rules
from tidemark.streaming.asof import SALTS, as_of


def _is_ntz(df: DataFrame) -> bool:
    return isinstance(df.schema["event_time"].dataType, TimestampNTZType)


def valid_trades(trades: DataFrame, delay: str | None) -> DataFrame:
    """Watermark (streams only) then keep trades with a positive price.

    Watermarks need an instant (TIMESTAMP); a TIMESTAMP_NTZ event time (UTC
    wall clock) is converted exactly for the stream and the window bounds are
    converted back, so stream and batch results carry the same type.
    """
    if trades.isStreaming:
        if _is_ntz(trades):
            trades = trades.withColumn("event_time", ntz_to_instant("event_time")) \
                           .withColumn("_ntz", F.lit(True))
        if delay:
            trades = trades.withWatermark("event_time", delay)
    return apply_rules(trades, trade_rules())


def _bounds(width: str):
    w = F.window("event_time", width)
    return w.alias("window")


def _window_cols(src: DataFrame):
    """window.start/end as window_start/window_end, back in NTZ where the
    input event time was NTZ."""
    start, end = F.col("window.start"), F.col("window.end")
    if src.isStreaming and "_ntz" in src.columns:
        start, end = instant_to_ntz(start), instant_to_ntz(end)
    return [start.alias("window_start"), end.alias("window_end")]


STATIC_JOINS = ("broadcast", "auto", "shuffle")


def _static(df: DataFrame, how: str) -> DataFrame:
    """The static side of an enrichment join, with the strategy the caller names.

    The static sides hold one row per listed symbol (one per symbol and
    exchange for listings): some ten thousand rows whatever the number of
    trades.  "broadcast" (default) makes that side the build side, so the trades
    are never shuffled by symbol nor broadcast themselves.  For a universe that
    does not fit every executor, "shuffle" sorts and merges both sides, and
    "auto" leaves the choice to Spark's sizes.
    """
    if how not in STATIC_JOINS:
        raise ValueError(f"static_join must be one of {STATIC_JOINS}, not {how!r}")
    return {"broadcast": F.broadcast, "shuffle": lambda d: d.hint("merge"), "auto": lambda d: d}[how](df)


def window_count_baseline(trades: DataFrame, width: str = C.SQ3_WINDOW[0]) -> DataFrame:
    """Per-symbol baseline for ``trade_frequency``: the mean number of trades
    per ``width`` window over the given (historical) trades.  Two hash
    aggregates, both partial before their shuffle."""
    per_window = (apply_rules(trades, trade_rules())
                  .groupBy(F.window("event_time", width).alias("w"), "symbol")
                  .agg(F.count("price").alias("n")))
    return per_window.groupBy("symbol").agg(F.avg("n").alias("baseline"))


def price_volatility(trades: DataFrame, width: str = C.SQ1_WINDOW[0],
                     delay: str | None = C.SQ1_WINDOW[1]) -> DataFrame:
    """SQ1: per window and symbol the mean and sample stddev of the price, the
    trade count and the coefficient of variation (%); single-trade windows
    (stddev NULL) are dropped."""
    src = valid_trades(trades, delay)
    agg = (src
           .groupBy(_bounds(width), "symbol")
           .agg(F.avg("price").alias("avg_price"),
                F.stddev_samp("price").alias("stddev_price"),
                F.count("price").alias("trade_count")))
    return agg.filter(F.col("stddev_price").isNotNull()).select(
        *_window_cols(src), "symbol",
        F.round("avg_price", 4).alias("avg_price"),
        F.round("stddev_price", 4).alias("stddev_price"),
        F.round(F.col("stddev_price") / F.col("avg_price") * 100, 4).alias("volatility_coeff"),
        "trade_count")


def snapshot_prev_close(snapshot: DataFrame) -> DataFrame:
    """symbol, prev_close of the snapshot rows with a positive previous close."""
    return snapshot.select("symbol", "prev_close").filter(
        F.col("prev_close").isNotNull() & (F.col("prev_close") > 0))


def market_sentiment(trades: DataFrame, snapshot: DataFrame, width: str = C.SQ2_WINDOW[0],
                     delay: str | None = C.SQ2_WINDOW[1],
                     static_join: str = "broadcast", emit: str = "update") -> DataFrame:
    """SQ2: per window and exchange, trades priced above / below their
    symbol's previous close, and rising / (rising + falling).  A symbol
    counts for every exchange it is listed on; flat trades count in neither.

    A trade meets one row, its symbol's previous close.  A batch counts per
    (window, symbol) and fans the counts out to the exchanges.  So does a stream
    with emit="closed": two stateful windows in a row, the second fed with the
    windows that the first has closed, so each window comes once and complete
    (append mode).  With emit="update" a stream gives every change of a window;
    it has one stateful aggregate only, so there the trade is fanned out before it.
    """
    if emit not in ("update", "closed"):
        raise ValueError(f"emit must be 'update' or 'closed', not {emit!r}")
    listed = snapshot.filter(F.col("prev_close").isNotNull() & (F.col("prev_close") > 0))
    src = valid_trades(trades, delay)
    side = direction("price", F.col("prev_close"))
    if src.isStreaming and emit == "update":
        listings = listed.select("symbol", "prev_close", F.explode("exchange").alias("exchange"))
        agg = (src.join(_static(listings, static_join), "symbol").groupBy(_bounds(width), "exchange")
               .agg(F.count_if(side == "up").alias("rising_count"),
                    F.count_if(side == "down").alias("falling_count")))
    else:
        closes = listed.select("symbol", "prev_close")
        per_symbol = (src.join(_static(closes, static_join), "symbol").groupBy(_bounds(width), "symbol")
                      .agg(F.count_if(side == "up").alias("rising"),
                           F.count_if(side == "down").alias("falling")))
        exchanges = listed.select("symbol", F.explode("exchange").alias("exchange"))
        agg = _exchange_totals(per_symbol.join(_static(exchanges, static_join), "symbol"), width)
    return _sentiment(agg, src)


def _exchange_totals(per_symbol: DataFrame, width: str) -> DataFrame:
    """Counts per (window, symbol) and exchange -> counts per (window, exchange).

    On a stream the window is made again from the first one's own time, so that
    the second aggregate knows the watermark.
    """
    window = F.window(F.window_time("window"), width).alias("window") if per_symbol.isStreaming else F.col("window")
    return per_symbol.groupBy(window, "exchange").agg(
        F.sum("rising").alias("rising_count"), F.sum("falling").alias("falling_count"))


def _sentiment(agg: DataFrame, src: DataFrame) -> DataFrame:
    moved = F.col("rising_count") + F.col("falling_count")
    return agg.filter(moved > 0).select(
        *_window_cols(src), "exchange", "rising_count", "falling_count",
        F.round(F.col("rising_count") / moved, 4).alias("sentiment_ratio"))


def market_sentiment_as_of(trades: DataFrame, snapshots: DataFrame, valid_from: str = "valid_from",
                           width: str = C.SQ2_WINDOW[0], delay: str | None = C.SQ2_WINDOW[1],
                           salts: int = SALTS) -> DataFrame:
    """SQ2 with snapshots that are refreshed while the stream runs: every trade
    is compared with the snapshot in force at its own time.

    ``snapshots`` (symbol, exchange list, prev_close, ``valid_from``) is a stream
    where ``trades`` is one; rows without a positive previous close are left out,
    so a symbol keeps its earlier one.  Closed windows only (append mode).
    """
    ntz = _is_ntz(trades)
    src = apply_rules(trades, trade_rules()).select("symbol", "price", "event_time")
    listed = snapshots.filter(F.col("prev_close").isNotNull() & (F.col("prev_close") > 0))
    if ntz:
        src = src.withColumn("event_time", ntz_to_instant("event_time"))
    if isinstance(listed.schema[valid_from].dataType, TimestampNTZType):
        listed = listed.withColumn(valid_from, ntz_to_instant(valid_from))
    side = direction("price", F.col("prev_close"))
    met = as_of(src, listed, "symbol", "event_time", valid_from, ["prev_close", "exchange"], delay, salts)
    per_symbol = met.groupBy(_bounds(width), "symbol", "exchange").agg(
        F.count_if(side == "up").alias("rising"), F.count_if(side == "down").alias("falling"))
    fanned = per_symbol.withColumn("exchange", F.explode("exchange"))
    out = _sentiment(_exchange_totals(fanned, width), met)
    return out.withColumns({c: instant_to_ntz(c) for c in ("window_start", "window_end")}) if ntz else out


def trade_frequency(trades: DataFrame,
                    baseline: float | DataFrame = C.TRADES_PER_WINDOW_BASELINE,
                    factor: float = C.HIGH_FREQUENCY_FACTOR, width: str = C.SQ3_WINDOW[0],
                    delay: str | None = C.SQ3_WINDOW[1],
                    static_join: str = "broadcast") -> DataFrame:
    """SQ3: trades per window and symbol, flagged when above ``factor`` x the
    baseline.  ``baseline`` is a constant trades-per-window, or a frame
    (symbol, baseline) of per-symbol baselines; symbols missing from it are
    not flagged (NULL)."""
    src = valid_trades(trades, delay)
    agg = src.groupBy(_bounds(width), "symbol").agg(F.count("price").alias("trade_count"))
    out = agg.select(*_window_cols(src), "symbol", "trade_count")
    if isinstance(baseline, DataFrame):
        base = _static(baseline.select("symbol", F.col("baseline").alias("_base")), static_join)
        out = out.join(base, "symbol", "left")
        flag = F.col("trade_count") > F.col("_base") * factor
        return out.withColumn("is_high_frequency", flag).drop("_base")
    return out.withColumn("is_high_frequency", F.col("trade_count") > F.lit(baseline * factor))


def valid_extremes(baselines: DataFrame) -> DataFrame:
    return baselines.select("symbol", "max_7d_high", "min_7d_low").filter(
        F.col("max_7d_high").isNotNull() & F.col("min_7d_low").isNotNull()
        & (F.col("max_7d_high") > 0) & (F.col("min_7d_low") > 0))


def price_vs_range(trades: DataFrame, baselines: DataFrame, width: str = C.SQ4_WINDOW[0],
                   delay: str | None = C.SQ4_WINDOW[1], near_pct: float = C.NEAR_EXTREME_PCT,
                   static_join: str = "broadcast") -> DataFrame:
    """SQ4: mean price per window and symbol against the symbol's recent
    high/low: percent below the high, above the low, and near_high /
    near_low / neutral on the rounded percentages."""
    return enrich_range(mean_price(trades, width, delay), baselines, near_pct, static_join)


def mean_price(trades: DataFrame, width: str, delay: str | None) -> DataFrame:
    """window_start, window_end, symbol, current_price: the part of SQ4 and SQ5
    that needs state and no static side."""
    src = valid_trades(trades, delay)
    agg = src.groupBy(_bounds(width), "symbol").agg(F.avg("price").alias("current_price"))
    return agg.select(*_window_cols(src), "symbol", "current_price")


def enrich_range(prices: DataFrame, baselines: DataFrame, near_pct: float = C.NEAR_EXTREME_PCT,
                 static_join: str = "broadcast") -> DataFrame:
    """SQ4 from window means and the recent extremes."""
    j = prices.join(_static(valid_extremes(baselines), static_join), "symbol")
    j = j.withColumns({"pct_from_high": pct_below("max_7d_high", "current_price"),
                       "pct_from_low": pct_above("current_price", "min_7d_low")})
    return j.select(
        "window_start", "window_end", "symbol",
        F.round("current_price", 4).alias("current_price"),
        F.round("max_7d_high", 4).alias("max_7d_high"),
        F.round("min_7d_low", 4).alias("min_7d_low"),
        "pct_from_high", "pct_from_low",
        range_position("pct_from_high", "pct_from_low", near_pct).alias("position"))


def vs_prev_close(trades: DataFrame, snapshot: DataFrame, width: str = C.SQ5_WINDOW[0],
                  delay: str | None = C.SQ5_WINDOW[1],
                  static_join: str = "broadcast") -> DataFrame:
    """SQ5: mean price per window and symbol against the previous close:
    deviation (%) rounded to 4 places and its direction (on the rounded
    value)."""
    return enrich_prev_close(mean_price(trades, width, delay), snapshot, static_join)


def enrich_prev_close(prices: DataFrame, snapshot: DataFrame,
                      static_join: str = "broadcast") -> DataFrame:
    """SQ5 from window means and the snapshot."""
    j = prices.join(_static(snapshot_prev_close(snapshot), static_join), "symbol")
    dev = F.round((F.col("current_price") - F.col("prev_close")) / F.col("prev_close") * 100, 4)
    j = j.withColumn("deviation_pct", dev)
    return j.select(
        "window_start", "window_end", "symbol",
        F.round("current_price", 4).alias("current_price"),
        F.round("prev_close", 4).alias("prev_close"),
        "deviation_pct",
        direction("deviation_pct").alias("direction"))
