"""Physical plan shapes the design relies on (final adaptive plans)."""

import re

import pytest

from tidemark.plans import layers, questions as q
from tidemark.plans.lake import Lake, build_steps
from tidemark.sources import fixtures


@pytest.fixture(scope="module")
def lake(spark, sf_small, tmp_path_factory):
    lk = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    for _, action in build_steps(lk, lambda: fixtures.bars(spark, sf_small),
                                 lambda: fixtures.exchange_dim(spark, sf_small),
                                 lambda: fixtures.daily_quotes(spark, sf_small)):
        action()
    return lk


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


def count(plan: str, node: str) -> int:
    return len(re.findall(rf"\b{node}\b", plan))


def shuffles(plan: str) -> int:
    """Shuffle exchanges (broadcasts excluded)."""
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hashpartitioning|rangepartitioning|"
                          r"SinglePartition|RoundRobinPartitioning)", plan))


def test_daily_metrics_one_shuffle_one_sort(lake):
    p = final_plan(layers.daily_metrics(lake.read("stock_prices")))
    assert shuffles(p) == 1 and count(p, "Sort") == 1 and count(p, "Window") == 1


def test_period_performance_is_a_sort_free_hash_aggregate(lake):
    for period in ("month", "year"):
        p = final_plan(layers.period_performance(lake.read("stock_prices"), period))
        assert count(p, "Sort") == 0 and count(p, "SortAggregate") == 0
        assert count(p, "HashAggregate") == 2 and shuffles(p) == 1


def test_top_n_uses_window_group_limit_and_broadcast_dims(lake):
    p = final_plan(q.top_n_per_exchange_year(lake.read("yearly_stock_performance"),
                                             lake.read("ticker_exchanges"),
                                             lake.read("exchange_dim")))
    assert count(p, "WindowGroupLimit") == 2          # partial + final
    assert count(p, "BroadcastHashJoin") == 2 and count(p, "SortMergeJoin") == 0


def test_group_mean_join_is_broadcast_at_run_time(lake):
    p = final_plan(q.outperformance_rate(lake.read("yearly_stock_performance"),
                                         lake.read("ticker_exchanges"),
                                         lake.read("exchange_dim"), min_years=1, mean_method="join"))
    assert count(p, "SortMergeJoin") == 0 and count(p, "Window") == 0
    p = final_plan(q.above_period_mean(lake.read("daily_stock_metrics")))
    assert count(p, "Window") == 0 and count(p, "SortMergeJoin") == 0


def test_streaks_one_shuffle_hash_aggregate(lake):
    p = final_plan(q.positive_streaks(lake.read("monthly_stock_performance")))
    assert shuffles(p) == 1 and count(p, "SortAggregate") == 0


def test_scans_prune_columns_and_push_filters(lake):
    df = q.above_period_mean(lake.read("daily_stock_metrics"))
    final_plan(df)
    text = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(rolling_volatility_30d)" in text
    schemas = re.findall(r"ReadSchema: struct<[^>]*>", text)
    assert schemas and all("open_price" not in s for s in schemas)


def test_quote_open_close_stays_a_hash_aggregate(spark, sf_small):
    p = final_plan(fixtures.daily_quotes(spark, sf_small))
    assert count(p, "SortAggregate") == 0 and count(p, "HashAggregate") >= 2


def test_bars_are_a_hash_aggregate_that_reads_once(spark, sf_small):
    p = final_plan(fixtures.bars(spark, sf_small, order="lead"))
    assert count(p, "SortAggregate") == 0 and count(p, "HashAggregate") >= 2
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", p)) == 1 and shuffles(p) == 1  # no tie: no second pass


def test_outperformance_reads_the_bars_once(spark, sf_small):
    from tidemark.plans.catalog import QUERIES
    text = QUERIES["q06_outperformance"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    initial = text.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", initial)) <= 2  # silver and the bridge
    assert initial.count("l_extendedprice") > 0


def test_stream_questions_build_on_the_static_side(spark, sf_small):
    from tidemark.streaming import questions as sq
    trades = fixtures.trades(spark, sf_small)
    quotes = fixtures.daily_quotes(spark, sf_small)
    snapshot, baselines = layers.latest_snapshot(quotes), layers.quote_baselines(quotes)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            for df in (sq.market_sentiment(trades, snapshot), sq.price_vs_range(trades, baselines),
                       sq.vs_prev_close(trades, snapshot)):
                p = final_plan(df)
                assert "BuildLeft" not in p and count(p, "SortMergeJoin") == 0 and "SinglePartition" not in p.split("Subquery")[0]
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
