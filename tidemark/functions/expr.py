"""Column -> Column expressions shared by every layer and question.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType

from tidemark import constants as C

ColumnOrName = Column | str


def _c(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pct_change(new: ColumnOrName, base: ColumnOrName, scale: float = 100.0) -> Column:
    """(new - base) / base * scale, NULL unless base > 0."""
    new, base = _c(new), _c(base)
    return F.when(base > 0, (new - base) / base * F.lit(scale))


def ratio_if_positive(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL unless den > 0 (volume ratio, range over open)."""
    num, den = _c(num), _c(den)
    return F.when(den > 0, num / den)


def direction(value: ColumnOrName, ref: ColumnOrName | float | None = None,
              labels: tuple[str, str, str] = ("up", "down", "flat")) -> Column:
    """'up' if value > ref, 'down' if value < ref, else 'flat' (NULL -> flat)."""
    value = _c(value)
    ref = F.lit(0) if ref is None else (F.lit(ref) if isinstance(ref, (int, float)) else _c(ref))
    up, down, flat = labels
    return (F.when(value > ref, F.lit(up))
            .when(value < ref, F.lit(down))
            .otherwise(F.lit(flat)))


def pct_below(high: ColumnOrName, price: ColumnOrName, digits: int | None = 4) -> Column:
    """How far price sits below high, in percent of high."""
    high, price = _c(high), _c(price)
    out = (high - price) / high * 100
    return F.round(out, digits) if digits is not None else out


def pct_above(price: ColumnOrName, low: ColumnOrName, digits: int | None = 4) -> Column:
    """How far price sits above low, in percent of low."""
    price, low = _c(price), _c(low)
    out = (price - low) / low * 100
    return F.round(out, digits) if digits is not None else out


def range_position(pct_from_high: ColumnOrName, pct_from_low: ColumnOrName,
                   near_pct: float = C.NEAR_EXTREME_PCT) -> Column:
    """near_high if within near_pct of the high (high wins, above the high counts
    as near_high), else near_low if within near_pct of the low, else neutral."""
    hi, lo = _c(pct_from_high), _c(pct_from_low)
    return (F.when(hi <= near_pct, F.lit("near_high"))
            .when(lo <= near_pct, F.lit("near_low"))
            .otherwise(F.lit("neutral")))


def safe_cast(value: ColumnOrName, to: DataType | str) -> Column:
    """Cast that yields NULL for unparsable input instead of failing under ANSI.

    Integral targets first drop a trailing fraction ("12.0" -> 12), as the
    legacy string-to-long cast did.
    """
    value = _c(value)
    dtype = to if isinstance(to, DataType) else DataType.fromDDL(to)
    if isinstance(dtype, IntegralType) and not isinstance(dtype, DecimalType):
        value = F.regexp_replace(F.trim(value.cast("string")), r"\.\d*$", "")
    return value.try_cast(dtype)


def safe_date(value: ColumnOrName, fmt: str = C.BAR_DATE_FORMAT) -> Column:
    """Parse a date string; NULL for anything that does not parse."""
    return F.try_to_date(_c(value), fmt)


def calendar_parts(df: DataFrame, date: str = "trade_date") -> DataFrame:
    """Add year, month, quarter and day_of_week (1 = Sunday)."""
    d = F.col(date)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "day_of_week": F.dayofweek(d),
    })


def epoch_ms_to_ntz(ms: ColumnOrName) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock), independent of the
    session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").try_cast("timestamp_ntz")
    return F.timestamp_add("MILLISECOND", _c(ms), epoch)


def ntz_to_instant(ts: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> TIMESTAMP (an instant), exactly and
    independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").try_cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, _c(ts)))


def instant_to_ntz(ts: ColumnOrName) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding its UTC wall clock."""
    epoch = F.lit("1970-01-01 00:00:00").try_cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), epoch)


def ntz_to_epoch_ms(ts: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> epoch milliseconds."""
    epoch = F.lit("1970-01-01 00:00:00").try_cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, _c(ts))
