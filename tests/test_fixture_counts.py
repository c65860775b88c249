"""Row counts and category splits stated in FIXTURES.md (B3, B5), checked
with the operators at a second scale factor."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from tidemark.plans.catalog import QUERIES

# FIXTURES.md B5, sf0.001 column
EXPECTED_SMALL = {
    "q01_top_n": 105, "q02_period_change": 175, "q03_worst_vs_mean": 83, "q04_recovery": 100,
    "q05_cumulative_rank": 1907, "q06_outperformance": 0, "q07_above_mean": 1500, "q07_rounded": 1492,
    "q08_spike_followup": 250, "q08_trading_day": 274, "q09_percentile": 9535,
    "q10_streaks": 5, "sq1_price_volatility": 23, "sq2_market_sentiment": 1978,
    "sq3_trade_frequency": 977, "sq4_price_vs_range": 987, "sq5_vs_prev_close": 1000,
}


@pytest.mark.parametrize("name", sorted(EXPECTED_SMALL))
def test_counts_at_sf0001(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() == EXPECTED_SMALL[name]


def test_independent_streak_bounds_differ_where_runs_cross_new_year(spark):
    def rows(name, sf):
        return {tuple(r) for r in QUERIES[name](spark, sf).collect()}
    for sf, total, wrong in ((SF_SMALL, 5, 2), (SF_ORACLE, 16, 7)):
        first_last, independent = rows("q10_streaks", sf), rows("q10_independent_bounds", sf)
        assert len(first_last) == len(independent) == total
        assert len(first_last - independent) == wrong


def test_stream_category_splits_at_sf001(spark):
    pos = {r.position: r["count"] for r in
           QUERIES["sq4_price_vs_range"](spark, SF_ORACLE).groupBy("position").count().collect()}
    assert pos == {"near_high": 25, "near_low": 20, "neutral": 8908}
    d = {r.direction: r["count"] for r in
         QUERIES["sq5_vs_prev_close"](spark, SF_ORACLE).groupBy("direction").count().collect()}
    assert d == {"up": 4861, "down": 4921, "flat": 6}
    snap = QUERIES["latest_snapshot"](spark, SF_ORACLE)
    assert snap.select(F.max("quote_date")).first()[0] == "2024-01-30"
    quotes = QUERIES["daily_quotes"](spark, SF_ORACLE)
    assert quotes.count() == 150 and quotes.filter(F.col("prev_close").isNotNull()).count() == 145
