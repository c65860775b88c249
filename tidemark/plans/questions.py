"""The ten batch questions as parameterised DataFrame operators over the
layers.  Defaults reproduce the reference questions; options cover the
documented variants (compounded returns, adjacent periods, next trading day,
independent streak bounds).

Results are unordered sets; ``present`` applies a presentation order where a
caller wants one.  Only the top-k report (``recovery_after_drop``) sorts,
because the limit is its feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as C
from tidemark.functions.expr import direction
from tidemark.operators.windows import (
    compounded, lag_value, rank_in_group, running_sum, spec, streaks, top_n_per_group, vs_group_mean,
)


def present(df: DataFrame, *order) -> DataFrame:
    """Sort for display or export; a name that starts with ``-`` descends.
    Never sort before a partitioned write."""
    keys = [F.col(c[1:]).desc() if isinstance(c, str) and c.startswith("-") else c for c in order]
    return df.orderBy(*keys)


def with_exchanges(perf: DataFrame, bridge: DataFrame, dim: DataFrame) -> DataFrame:
    """Fan a per-ticker table out to one row per listing exchange, with the
    exchange name.  Join strategy is Spark's: the bridge and the dimension are
    broadcast when their (estimated or, under AQE, measured) size is small,
    shuffled otherwise."""
    return perf.join(bridge, "ticker").join(dim, "exchange_id")


def top_n_per_exchange_year(yearly: DataFrame, bridge: DataFrame, dim: DataFrame,
                            n: int = C.TOP_N) -> DataFrame:
    """Q01: the n best yearly returns per (exchange, year); RANK, ties kept."""
    base = yearly.filter(F.col("yearly_return_pct").isNotNull()).select(
        "ticker", "year", "yearly_return_pct")
    ranked = top_n_per_group(with_exchanges(base, bridge, dim), ["exchange_id", "year"],
                             [F.col("yearly_return_pct").desc()], n, name="return_rank")
    return ranked.select("exchange_id", "exchange_name", "year", "ticker",
                         "yearly_return_pct", "return_rank")


def period_over_period_change(perf: DataFrame, keys=("ticker",), order=("year",),
                              value: str = "yearly_return_pct",
                              prev_name: str = "prev_year_return_pct",
                              change_name: str = "yoy_return_change",
                              digits: int = C.RETURN_DIGITS,
                              require_adjacent: bool = False) -> DataFrame:
    """Q02: value minus the previous row's value per key.  With
    ``require_adjacent`` the previous row counts only if it is the directly
    preceding period (order column differs by one); otherwise gaps are ignored."""
    keys, order = list(keys), list(order)
    base = perf.filter(F.col(value).isNotNull()).select(*keys, *order, value)
    prev = lag_value(value, keys, order)
    if require_adjacent:
        step = F.col(order[-1]) - lag_value(order[-1], keys, order)
        prev = F.when(step == 1, prev)
    out = base.withColumn(prev_name, prev)
    return out.withColumn(change_name, F.round(F.col(value) - F.col(prev_name), digits))


def worst_vs_own_mean(monthly: DataFrame, digits: int = C.RETURN_DIGITS,
                      mean_method: str = "join") -> DataFrame:
    """Q03: per (year, month) the ticker whose monthly return fell furthest
    below its own all-time mean monthly return (RANK = 1, ties kept).
    ``mean_method``: see ``vs_group_mean``."""
    base = monthly.filter(F.col("monthly_return_pct").isNotNull()).select(
        "ticker", "year", "month", "monthly_return_pct")
    dev = vs_group_mean(base, ["ticker"], "monthly_return_pct", "avg_monthly_return_pct",
                        "return_vs_avg", method=mean_method)
    worst = top_n_per_group(dev, ["year", "month"], [F.col("return_vs_avg").asc()], 1,
                            name="drop_rank")
    return worst.select(
        "year", "month", "ticker",
        F.round("monthly_return_pct", digits).alias("monthly_return_pct"),
        F.round("avg_monthly_return_pct", digits).alias("avg_monthly_return_pct"),
        F.round("return_vs_avg", digits).alias("return_vs_avg"))


def recovery_after_drop(monthly: DataFrame, window: int = C.RECOVERY_ROWS,
                        limit: int | None = C.RECOVERY_LIMIT, compound: bool = False,
                        digits: int = C.RETURN_DIGITS) -> DataFrame:
    """Q04: months that follow a negative month and close a ``window``-row run
    with a positive total return; the ``limit`` largest recoveries.

    The total is the sum of monthly percentages (``compound=True`` chains
    them).  Ties at the cut are resolved by (ticker, year, month) so the
    report is deterministic.
    """
    k, o = ["ticker"], ["year", "month"]
    base = monthly.filter(F.col("monthly_return_pct").isNotNull()).select(
        "ticker", "year", "month", "monthly_return_pct")
    frame = spec(k, o).rowsBetween(-(window - 1), 0)
    r = F.col("monthly_return_pct")
    total = compounded(r, frame) if compound else F.sum(r).over(frame)
    staged = base.withColumns({"prev_month_return_pct": lag_value("monthly_return_pct", k, o),
                               "rolling_return": total})
    hits = staged.filter((F.col("prev_month_return_pct") < 0) & (F.col("rolling_return") > 0))
    out = hits.select(
        "ticker", "year", "month",
        F.round("prev_month_return_pct", digits).alias("drop_month_return_pct"),
        F.round("rolling_return", digits).alias("rolling_3month_recovery_pct"))
    if limit is None:
        return out
    return (out.orderBy(F.col("rolling_3month_recovery_pct").desc(), "ticker", "year", "month")
            .limit(limit))


def cumulative_rank(monthly: DataFrame, compound: bool = False,
                    digits: int = C.RETURN_DIGITS) -> DataFrame:
    """Q05: year-to-date return per ticker and month, ranked across tickers in
    each (year, month) on the unrounded value.  A ranking group holds one row
    per ticker: bounded by the universe, not by the input volume."""
    base = monthly.filter(F.col("monthly_return_pct").isNotNull()).select(
        "ticker", "year", "month", "monthly_return_pct")
    cum = running_sum(base, ["ticker", "year"], ["month"], "monthly_return_pct",
                      name="cumulative_return_pct", compound=compound)
    ranked = rank_in_group(cum, ["year", "month"], [F.col("cumulative_return_pct").desc()],
                           name="cumulative_rank")
    return ranked.select(
        "ticker", "year", "month",
        F.round("monthly_return_pct", digits).alias("monthly_return_pct"),
        F.round("cumulative_return_pct", digits).alias("cumulative_return_pct"),
        "cumulative_rank")


def outperformance_rate(yearly: DataFrame, bridge: DataFrame, dim: DataFrame,
                        min_years: int = C.MIN_YEARS, mean_method: str = "window") -> DataFrame:
    """Q06: per (ticker, exchange) the number of years the ticker's return beat
    the exchange's mean return that year, the years counted, and the rate (%).
    Years need not be consecutive.

    The mean is a window over (exchange, year): one row per listed ticker, so a
    group is bounded by the universe, and the yearly layer is read once (the
    join form reads it twice, see ``vs_group_mean``)."""
    base = yearly.filter(F.col("yearly_return_pct").isNotNull()).select(
        "ticker", "year", "yearly_return_pct")
    j = vs_group_mean(with_exchanges(base, bridge, dim), ["exchange_id", "year"],
                      "yearly_return_pct", "exchange_avg_return_pct", method=mean_method)
    beat = F.when(F.col("yearly_return_pct") > F.col("exchange_avg_return_pct"), 1).otherwise(0)
    counts = (j.groupBy("ticker", "exchange_id", "exchange_name")
              .agg(F.sum(beat).cast("bigint").alias("years_outperformed"),
                   F.count(F.lit(1)).alias("total_years"))
              .filter(F.col("years_outperformed") >= min_years))
    rate = F.round(F.col("years_outperformed") * 100.0 / F.col("total_years"), C.RATE_DIGITS)
    return counts.withColumn("outperformance_rate_pct", rate.cast("double"))


def above_period_mean(daily: DataFrame, digits: int = C.VOLATILITY_DIGITS,
                      filter_digits: int | None = None,
                      mean_method: str = "join") -> DataFrame:
    """Q07: days whose 30-row volatility exceeds the ticker's mean volatility
    of that year, compared as they are.  With ``filter_digits`` the excess
    counts only if it is positive after rounding to so many digits, which also
    drops true excesses below that."""
    base = daily.filter(F.col("rolling_volatility_30d").isNotNull()).select(
        "ticker", "trade_date", "year", "rolling_volatility_30d")
    j = vs_group_mean(base, ["ticker", "year"], "rolling_volatility_30d",
                      "annual_avg_volatility", "excess", method=mean_method)
    keep = (F.round("excess", filter_digits) > 0 if filter_digits is not None
            else F.col("rolling_volatility_30d") > F.col("annual_avg_volatility"))
    return j.filter(keep).select(
        "ticker", "trade_date", "year",
        F.round("rolling_volatility_30d", digits).alias("rolling_volatility_30d"),
        F.round("annual_avg_volatility", digits).alias("annual_avg_volatility"),
        F.round("excess", digits).alias("volatility_above_avg"))


def spike_followup(daily: DataFrame, next: str = "row_after_filter") -> DataFrame:
    """Q08: volume-spike days with the following change and its direction.

    next="row_after_filter": the change of the next *spike* day (the filter
    runs before LEAD, as in the reference).  next="trading_day": the change
    of the next trading day of the ticker.
    """
    cols = ["ticker", "trade_date", "year", "volume", "avg_volume_20d", "volume_ratio",
            "daily_change_pct"]
    k, o = ["ticker"], ["trade_date"]
    spike = F.col("is_volume_spike") == F.lit(True)
    if next == "row_after_filter":
        staged = daily.filter(spike).select(*cols).withColumn(
            "next_day_change_pct", lag_value("daily_change_pct", k, o, offset=-1))
    elif next == "trading_day":
        staged = daily.select(*cols, "is_volume_spike").withColumn(
            "next_day_change_pct", lag_value("daily_change_pct", k, o, offset=-1)
        ).filter(spike)
    else:
        raise ValueError("next must be 'row_after_filter' or 'trading_day'")
    return staged.filter(F.col("next_day_change_pct").isNotNull()).select(
        "ticker", "trade_date", "year", "volume", "avg_volume_20d",
        F.round("volume_ratio", 4).alias("volume_ratio"),
        F.round("daily_change_pct", 6).alias("spike_day_change_pct"),
        F.round("next_day_change_pct", 6).alias("next_day_change_pct"),
        direction("next_day_change_pct").alias("next_day_direction"))


def percentile_in_group(monthly: DataFrame, bridge: DataFrame, dim: DataFrame,
                        value: str = "avg_intraday_range_pct",
                        name: str = "volatility_percentile") -> DataFrame:
    """Q09: PERCENT_RANK of a monthly measure among the tickers of the same
    exchange and month (one row per listed ticker in a group)."""
    base = monthly.filter(F.col(value).isNotNull()).select("ticker", "year", "month", value)
    ranked = rank_in_group(with_exchanges(base, bridge, dim), ["exchange_id", "year", "month"],
                           [F.col(value).asc()], method="percent_rank", name=name)
    return ranked.select("ticker", "exchange_id", "exchange_name", "year", "month",
                         F.round(value, 4).alias(value), F.round(name, 4).alias(name))


def positive_streaks(monthly: DataFrame, min_len: int = C.MIN_STREAK,
                     independent_bounds: bool = False,
                     require_adjacent: bool = False) -> DataFrame:
    """Q10: runs of at least ``min_len`` consecutive positive monthly returns
    per ticker, with first and last (year, month) and the length.

    Default bounds are the first and last month of the run; the reference's
    separate MIN/MAX of year and month is ``independent_bounds=True``.  With
    ``require_adjacent`` a missing month also ends a run.
    """
    base = monthly.filter(F.col("monthly_return_pct").isNotNull()).select(
        "ticker", "year", "month", "monthly_return_pct")
    runs = streaks(base, ["ticker"], ["year", "month"], F.col("monthly_return_pct") > 0,
                   min_len, index=F.col("year") * 12 + F.col("month"),
                   require_adjacent=require_adjacent, independent_bounds=independent_bounds)
    return runs.select(
        "ticker",
        F.col("start_year").alias("streak_start_year"),
        F.col("start_month").alias("streak_start_month"),
        F.col("end_year").alias("streak_end_year"),
        F.col("end_month").alias("streak_end_month"),
        F.col("length").alias("consecutive_months"))
