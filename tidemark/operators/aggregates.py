"""Aggregation building blocks.

First/last by order use ``min_by``/``max_by``: one hash aggregate with partial
aggregation and no sort, where the row_number(asc) + row_number(desc) form
costs a shuffle plus two sorts and cannot pre-aggregate a hot key.  An order over
more columns than fit one number goes through ``first_last_total``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_by(value: str | Column, order: str | Column) -> Column:
    """Value on the row with the smallest ``order`` (a struct gives a
    multi-column order)."""
    return F.min_by(_c(value), _c(order))


def last_by(value: str | Column, order: str | Column) -> Column:
    return F.max_by(_c(value), _c(order))


_HI_LIMIT = 2 ** 61


def pack_order(hi: str | Column, lo: str | Column) -> Column:
    """One DECIMAL(38,0) key ordering exactly like (hi, lo) for two BIGINTs,
    with ``hi`` in [-2^61, 2^61) (TIMESTAMP micros qualify until year ~75,000).

    ``min_by(x, struct(hi, lo))`` keeps a struct in the aggregation buffer,
    which Spark can only run as a sort-based aggregate; a decimal buffer stays
    in the hash aggregate.  (hi + 2^61) * 2^64 + (lo + 2^63) < 2^126 < 10^38.
    A ``hi`` outside the range raises an error instead of mis-ordering.
    """
    def dec(n: int) -> Column:
        return F.lit(str(n)).cast("decimal(38,0)")

    hi, lo = _c(hi).cast("decimal(38,0)"), _c(lo).cast("decimal(38,0)")
    key = (hi + dec(_HI_LIMIT)) * dec(2 ** 64) + (lo + dec(2 ** 63))
    in_range = (hi >= dec(-_HI_LIMIT)) & (hi < dec(_HI_LIMIT))
    return (F.when(hi.isNull() | lo.isNull(), F.lit(None).cast("decimal(38,0)"))
            .when(in_range, key.cast("decimal(38,0)"))
            .otherwise(F.raise_error(F.lit("pack_order: first key out of range"))
                       .cast("decimal(38,0)")))


def first_last(df: DataFrame, keys: Sequence[str], order: str | Column,
               first: Mapping[str, str | Column], last: Mapping[str, str | Column]) -> DataFrame:
    """Per group: ``first`` columns from the earliest row, ``last`` from the latest."""
    aggs = ([first_by(v, order).alias(k) for k, v in first.items()]
            + [last_by(v, order).alias(k) for k, v in last.items()])
    return df.groupBy(*keys).agg(*aggs)


LEAD_BITS = 47
_PARTS, _PART = 4, 16
_TIE_GROUPS = 1 << 16


def first_last_total(df: DataFrame, keys: Sequence[str], lead: str | Column, rest: Sequence[str | Column],
                     first: Mapping[str, str | Column], last: Mapping[str, str | Column],
                     others: Sequence[Column] = ()) -> DataFrame:
    """``first_last`` by a total order of many columns, without a struct in the aggregate.

    ``lead`` (BIGINT, not NULL, in [-2^46, 2^46), else the job fails) decides
    first; ``rest`` breaks ties, compared like a struct.  ``others`` are further
    aggregates, ``first`` and ``last`` come before them.

    One hash aggregate by ``lead`` answers every group whose first and last rows
    have a ``lead`` of their own.  It also tells the groups where they do not: the
    low bits of its order hold 16 bits of a hash of ``rest``, once ascending and
    once descending, so two different rows at the same end show two hash values
    (four such pairs make up a 64-bit hash).  Only tied groups are aggregated again
    by the whole order; without any, adaptive execution drops that second pass
    before it reads a row.  Its filter is at most 65,536 hash values of group keys.
    """
    keys = list(keys)
    lead = _c(lead).cast("bigint")
    limit = 1 << (LEAD_BITS - 1)
    checked = F.when((lead >= -limit) & (lead < limit), lead).otherwise(
        F.raise_error(F.lit("first_last_total: lead missing or out of range")).cast("bigint"))
    rest = [_c(c) for c in rest]
    low, mask = F.lit(1 << _PART), F.lit((1 << _PART) - 1)
    parts = [F.shiftrightunsigned(F.col("__hash"), k * _PART).bitwiseAND(mask) for k in range(_PARTS)]
    ranked = df.withColumns({"__lead": checked, "__hash": F.xxhash64(*rest)})
    ranked = ranked.withColumns({f"__up{k}": F.col("__lead") * low + p for k, p in enumerate(parts)}
                                | {f"__down{k}": F.col("__lead") * low + (mask - p) for k, p in enumerate(parts)})

    def tied(end, k: int) -> Column:
        up, down = end(f"__up{k}").bitwiseAND(mask), end(f"__down{k}").bitwiseAND(mask)
        return up + down != mask

    ties = reduce(lambda a, b: a | b, [tied(end, k) for end, wanted in ((F.min, first), (F.max, last)) if wanted
                                     for k in range(_PARTS)]).alias("__tied")
    quick = ranked.groupBy(*keys).agg(*[first_by(v, "__up0").alias(k) for k, v in first.items()],
                                      *[last_by(v, "__up0").alias(k) for k, v in last.items()], *others, ties)
    columns = [c for c in quick.columns if c != "__tied"]
    group = F.pmod(F.xxhash64(*keys), F.lit(_TIE_GROUPS)).alias("__group")
    # Always true; it reads every column, so that both uses of ``quick`` are one shuffle.
    whole = F.xxhash64(*columns) >= F.lit(-(1 << 63))
    groups = quick.where(F.col("__tied") & whole).select(group).distinct()

    order = F.struct("__lead", *rest)
    again = ranked.withColumn("__group", group).join(F.broadcast(groups), "__group", "left_semi").groupBy(*keys).agg(
        *[first_by(v, order).alias(k) for k, v in first.items()],
        *[last_by(v, order).alias(k) for k, v in last.items()], *others, ties)
    return quick.where(~F.col("__tied")).select(columns).unionByName(again.where("__tied").select(columns))


def rounded_mean_long(value: str | Column) -> Column:
    """Mean rounded half-up to a whole number, as BIGINT."""
    return F.round(F.avg(_c(value)), 0).cast("bigint")


def count_where(predicate: Column) -> Column:
    return F.count_if(F.coalesce(predicate, F.lit(False)))


def mean_where(value: Column, predicate: Column) -> Column:
    """Mean of ``value`` over rows where ``predicate`` holds (others ignored)."""
    return F.avg(F.when(predicate, value))
