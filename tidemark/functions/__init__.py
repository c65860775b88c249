from tidemark.functions.expr import (
    calendar_parts,
    direction,
    epoch_ms_to_ntz,
    ntz_to_epoch_ms,
    pct_above,
    pct_below,
    pct_change,
    range_position,
    ratio_if_positive,
    safe_cast,
    safe_date,
)

__all__ = [
    "calendar_parts", "direction", "epoch_ms_to_ntz", "ntz_to_epoch_ms", "pct_above",
    "pct_below", "pct_change", "range_position", "ratio_if_positive", "safe_cast", "safe_date",
]
