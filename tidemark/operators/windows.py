"""Window operators over ordered series: lag/lead, ranks, trailing frames,
running sums, deviation from a group mean, and streaks (gaps and islands).

Every window here has a PARTITION BY: a window without one would pull the
whole table into a single task.  Frames are row counts, as in the questions
("7d", "20d", "3 month" are rows, not calendar spans).

Operators that share (keys, order) share one Exchange + Sort + Window node in
the physical plan, so chaining them costs one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[str | Column]


def spec(keys: Sequence[str], order: Order | None = None):
    w = Window.partitionBy(*keys)
    return w.orderBy(*order) if order else w


def lag_value(value: str | Column, keys: Sequence[str], order: Order, offset: int = 1,
              default: str | Column | None = None) -> Column:
    """Value ``offset`` rows back (negative: forward).  ``default`` may be a
    column of the current row; it is used only where no such row exists, so a
    NULL value in an existing previous row stays NULL."""
    w = spec(keys, order)
    shifted = F.lag(value, offset).over(w) if offset >= 0 else F.lead(value, -offset).over(w)
    if default is None:
        return shifted
    exists = (F.lag(F.lit(1), offset).over(w) if offset >= 0
              else F.lead(F.lit(1), -offset).over(w)).isNotNull()
    default = F.col(default) if isinstance(default, str) else default
    return F.when(exists, shifted).otherwise(default)


def lag_lead(df: DataFrame, keys: Sequence[str], order: Order, value: str, offset: int = 1,
             default: str | Column | None = None, name: str | None = None) -> DataFrame:
    name = name or (f"prev_{value}" if offset >= 0 else f"next_{value}")
    return df.withColumn(name, lag_value(value, keys, order, offset, default))


_RANKERS = {
    "rank": F.rank,
    "dense_rank": F.dense_rank,
    "row_number": F.row_number,
    "percent_rank": F.percent_rank,
}


def rank_in_group(df: DataFrame, keys: Sequence[str], order: Order, method: str = "rank",
                  name: str = "rank") -> DataFrame:
    return df.withColumn(name, _RANKERS[method]().over(spec(keys, order)))


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Order, n: int,
                    method: str = "rank", name: str = "rank") -> DataFrame:
    """Rows ranked <= n per group; with RANK, ties at the cut are all kept.

    The filter sits directly on the rank so Spark inserts a partial
    WindowGroupLimit before the shuffle: each map task forwards at most its
    own top n per group.
    """
    return rank_in_group(df, keys, order, method, name).filter(F.col(name) <= n)


_TRAILING = {
    "avg": F.avg, "mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min,
    "stddev": F.stddev_samp, "count": F.count,
}


def trailing_value(value: str | Column, keys: Sequence[str], order: Order, func: str,
                   start: int, end: int = 0) -> Column:
    """Aggregate over the rows start..end relative to the current one
    (``start=-20, end=-1`` is the 20 rows before, current excluded)."""
    return _TRAILING[func](value).over(spec(keys, order).rowsBetween(start, end))


def trailing(df: DataFrame, keys: Sequence[str], order: Order, value: str, func: str,
             start: int, end: int = 0, name: str | None = None) -> DataFrame:
    name = name or f"{func}_{value}_{-start}"
    return df.withColumn(name, trailing_value(value, keys, order, func, start, end))


def compounded(value: str | Column, window) -> Column:
    """Chained percentage returns over a frame: (prod(1 + r/100) - 1) * 100.

    A return of -100 anywhere in the frame leaves -100 (the logarithm of zero
    has no sum); NULL returns are skipped; one below -100 is an error.
    """
    r = F.col(value) if isinstance(value, str) else value
    step = (F.when(r < -100, F.raise_error(F.lit("compounded: return below -100 %")).cast("double"))
            .when(r > -100, F.log1p(r / 100)))
    lost = F.bool_or(r == -100).over(window)
    return F.when(lost, F.lit(-100.0)).otherwise((F.exp(F.sum(step).over(window)) - 1) * 100)


def running_sum(df: DataFrame, keys: Sequence[str], order: Order, value: str,
                name: str | None = None, compound: bool = False) -> DataFrame:
    """Running total from the first row of the group.  ``compound=True`` chains
    percentage returns instead of adding them (``compounded``)."""
    w = spec(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    name = name or f"running_{value}"
    if compound:
        total = compounded(value, w)
    else:
        total = F.sum(value).over(w)
    return df.withColumn(name, total)


def vs_group_mean(df: DataFrame, keys: Sequence[str], value: str, mean_name: str,
                  diff_name: str | None = None, method: str = "join") -> DataFrame:
    """Add the mean of ``value`` over the whole group, and optionally the
    difference value - mean.

    method="join" (default): a grouped mean (map-side partial aggregation, so
    only one partial row per group and task is shuffled) joined back on the
    keys; the join is broadcast when the group count is small (AQE measures
    it), otherwise both sides are shuffled.  The rows themselves are never
    shuffled for a small group count.
    method="window": AVG() OVER (PARTITION BY keys), one shuffle of all rows.
    """
    keys = list(keys)
    if method == "window":
        out = df.withColumn(mean_name, F.avg(value).over(spec(keys)))
    elif method == "join":
        means = df.groupBy(*keys).agg(F.avg(value).alias(mean_name))
        out = df.join(means, keys)
    else:
        raise ValueError("method must be 'join' or 'window'")
    if diff_name:
        out = out.withColumn(diff_name, F.col(value) - F.col(mean_name))
    return out


def streaks(df: DataFrame, keys: Sequence[str], order: Sequence[str], predicate: Column,
            min_len: int, index: Column | None = None, require_adjacent: bool = False,
            independent_bounds: bool = False) -> DataFrame:
    """Runs of consecutive rows (per key, in ``order``) on which ``predicate``
    holds, at least ``min_len`` rows long.

    Output: keys, ``start_<c>``/``end_<c>`` for each order column, ``length``.
    A streak breaks when the predicate flips; with ``require_adjacent`` it
    also breaks on a gap in ``index`` (an integer period number increasing
    with ``order``, such as year * 12 + month).  Bounds are the first and last
    row of the run (``independent_bounds=True`` takes min and max of each
    order column separately instead).

    One Exchange: the streak aggregate groups by (keys, streak id), which the
    window's hash partitioning on ``keys`` already satisfies.  With an
    ``index`` the bounds are min_by/max_by on it, which keeps the aggregate a
    hash aggregate (a struct-valued min/max needs a sort-based one).
    """
    keys, order = list(keys), list(order)
    if require_adjacent and index is None:
        raise ValueError("require_adjacent needs an index column")
    flag = F.when(predicate, 1).otherwise(0)
    w = spec(keys, order)
    prev_flag = F.lag(F.col("_flag"), 1).over(w)
    changed = prev_flag.isNull() | (F.col("_flag") != prev_flag)
    if require_adjacent:
        changed = changed | ((F.col("_idx") - F.lag(F.col("_idx"), 1).over(w)) != 1)
    run_w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = (df.withColumn("_flag", flag)
              .withColumns({"_idx": index} if index is not None else {})
              .withColumn("_brk", F.when(changed, 1).otherwise(0))
              .withColumn("_streak", F.sum("_brk").over(run_w)))
    if independent_bounds:
        bounds = ([F.min(c).alias(f"start_{c}") for c in order]
                  + [F.max(c).alias(f"end_{c}") for c in order])
    elif index is not None:
        bounds = ([F.min_by(c, "_idx").alias(f"start_{c}") for c in order]
                  + [F.max_by(c, "_idx").alias(f"end_{c}") for c in order])
    else:
        pos = F.struct(*[F.col(c) for c in order])
        bounds = [F.min(pos).alias("_first"), F.max(pos).alias("_last")]
    grouped = (staged.groupBy(*keys, "_streak")
               .agg(*bounds, F.count(F.lit(1)).alias("length"), F.min("_flag").alias("_all"))
               .filter((F.col("_all") == 1) & (F.col("length") >= min_len)))
    if not independent_bounds and index is None:
        grouped = grouped.select(
            "*", *[F.col(f"_first.{c}").alias(f"start_{c}") for c in order],
            *[F.col(f"_last.{c}").alias(f"end_{c}") for c in order])
    cols = (keys + [f"start_{c}" for c in order] + [f"end_{c}" for c in order] + ["length"])
    return grouped.select(*cols)
