from tidemark.operators.aggregates import (
    count_where, first_by, first_last, last_by, mean_where, rounded_mean_long,
)
from tidemark.operators.quality import (
    apply_rules, bar_rules, clean_bars, dedupe_by_priority, derive_bar_columns,
    quality_report, quote_rules, trade_rules,
)
from tidemark.operators.windows import (
    lag_lead, lag_value, rank_in_group, running_sum, spec, streaks, top_n_per_group,
    trailing, trailing_value, vs_group_mean,
)

__all__ = [
    "apply_rules", "bar_rules", "clean_bars", "count_where",
    "dedupe_by_priority", "derive_bar_columns", "first_by", "first_last",
    "lag_lead", "lag_value", "last_by", "mean_where", "quality_report", "quote_rules",
    "rank_in_group", "rounded_mean_long", "running_sum", "spec", "streaks", "top_n_per_group",
    "trade_rules", "trailing", "trailing_value", "vs_group_mean",
]
