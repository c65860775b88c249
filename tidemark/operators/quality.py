"""Row-quality rules, the rule report, and deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import pct_change


def bar_rules(date: str = "trade_date") -> dict[str, Column]:
    """Rules a bar must pass to enter the silver layer (all must be TRUE)."""
    o, h, l, c, v = (F.col(x) for x in
                     ("open_price", "high_price", "low_price", "close_price", "volume"))
    return {
        "date_present": F.col(date).isNotNull(),
        "open_positive": o > 0,
        "high_positive": h > 0,
        "low_positive": l > 0,
        "close_positive": c > 0,
        "volume_present": v.isNotNull(),
        "volume_non_negative": v >= 0,
        "high_not_below_low": h >= l,
    }


def quote_rules() -> dict[str, Column]:
    return {
        "symbol_present": F.col("symbol").isNotNull(),
        "price_present": F.col("current_price").isNotNull(),
        "price_positive": F.col("current_price") > 0,
        "date_found": F.col("quote_date") != "",
    }


def trade_rules(price: str = "price") -> dict[str, Column]:
    return {"price_present": F.col(price).isNotNull(), "price_positive": F.col(price) > 0}


def _all(rules: Mapping[str, Column]) -> Column:
    return reduce(lambda a, b: a & b, rules.values())


def apply_rules(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Keep rows for which every rule is TRUE (NULL counts as failed)."""
    return df.filter(_all(rules))


def clean_bars(df: DataFrame, min_date: str | None = None, date: str = "trade_date") -> DataFrame:
    rules = bar_rules(date)
    if min_date is not None:
        rules["after_min_date"] = F.col(date) >= F.lit(min_date).cast("date")
    return apply_rules(df, rules)


def quality_report(df: DataFrame, rules: Mapping[str, Column],
                   measures: Sequence[str] = ()) -> DataFrame:
    """One row: total rows, rows failing each rule, rows passing all rules, and
    per column of ``measures`` the rows where it is NaN (which is greater than
    any number, so a rule such as ``> 0`` lets it pass).

    A single global aggregate with map-side partial counts, so it costs one
    scan and a one-row shuffle whatever the input size.
    """
    failed = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"failed_{name}")
              for name, rule in rules.items()]
    passed = F.count_if(F.coalesce(_all(rules), F.lit(False))).alias("passed")
    nan = [F.count_if(F.coalesce(F.isnan(c), F.lit(False))).alias(f"nan_{c}") for c in measures]
    return df.agg(F.count(F.lit(1)).alias("total"), *failed, passed, *nan)


def dedupe_by_priority(df: DataFrame, keys: Sequence[str], priority: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``priority`` tuple, ties broken
    by every remaining column, so the winner does not depend on partitioning or
    input order (unlike ``dropDuplicates``).  A NULL priority comes last.

    One aggregate, combined before the shuffle: a hot key costs one row per map
    task, not one row per duplicate.  The struct in its buffer makes it a
    sort-based aggregate, which here is the faster form: nearly every key has one
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ranked = [x for c in priority for x in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c))]
    order = F.struct(*ranked, *[F.col(c) for c in rest if c not in priority])
    winner = F.min_by(F.struct(*[F.col(c) for c in rest]), order).alias("_winner")
    return df.groupBy(*keys).agg(winner).select(*keys, "_winner.*")


def derive_bar_columns(df: DataFrame) -> DataFrame:
    """daily_range = high - low, daily_change = close - open,
    daily_change_pct = change / open * 100 (NULL unless open > 0)."""
    return df.withColumns({
        "daily_range": F.col("high_price") - F.col("low_price"),
        "daily_change": F.col("close_price") - F.col("open_price"),
        "daily_change_pct": pct_change("close_price", "open_price"),
    })
