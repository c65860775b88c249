"""Hand-made rows for the cases the provided tables never hit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import direction, range_position, safe_cast, safe_date
from tidemark.operators.quality import bar_rules, dedupe_by_priority, quality_report
from tidemark.plans import layers, questions as q

D = dt.date

BAR_COLS = ["ticker", "exchange_id", "trade_date", "open_price", "high_price", "low_price",
            "close_price", "adjusted_close_price", "volume"]


def bars_df(spark, rows):
    schema = ("ticker string, exchange_id int, trade_date date, open_price double, "
              "high_price double, low_price double, close_price double, "
              "adjusted_close_price double, volume bigint")
    return spark.createDataFrame(rows, schema)


def test_safe_casts(spark):
    df = spark.createDataFrame([("12.0",), ("12",), ("abc",), ("1.2e3",), (None,), (" 7 ",)],
                               "s string")
    got = [r[0] for r in df.select(safe_cast("s", "bigint")).collect()]
    assert got == [12, 12, None, None, None, 7]
    got = [r[0] for r in df.select(safe_cast("s", "double")).collect()]
    assert got[:4] == [12.0, 12.0, None, 1200.0]
    dates = spark.createDataFrame([("31-12-1999",), ("1999-12-31",), ("32-01-2000",)], "s string")
    assert [r[0] for r in dates.select(safe_date("s")).collect()] == [D(1999, 12, 31), None, None]


def test_bar_quality_rules_and_report(spark):
    rows = [
        ("A", 1, D(2000, 1, 3), 10.0, 11.0, 9.0, 10.5, 10.5, 100),   # clean
        ("A", 1, D(2000, 1, 4), 0.0, 11.0, 9.0, 10.5, 10.5, 100),    # zero open
        ("A", 1, D(2000, 1, 5), 10.0, 11.0, 9.0, None, None, 100),   # empty close
        ("A", 1, D(2000, 1, 6), 10.0, 11.0, 9.0, 10.5, 10.5, -1),    # negative volume
        ("A", 1, D(2000, 1, 7), 10.0, 8.0, 9.0, 10.5, 10.5, 100),    # high < low
        ("A", 1, None, 10.0, 11.0, 9.0, 10.5, 10.5, 100),            # unparsable date
    ]
    df = bars_df(spark, rows)
    assert layers.clean(df).count() == 1
    rep = quality_report(df, bar_rules()).first().asDict()
    assert rep["total"] == 6 and rep["passed"] == 1
    assert rep["failed_open_positive"] == 1
    assert rep["failed_close_positive"] == 1
    assert rep["failed_volume_non_negative"] == 1
    assert rep["failed_high_not_below_low"] == 1
    assert rep["failed_date_present"] == 1
    assert layers.clean(df, min_date="2000-01-04").count() == 0


def test_dedupe_lowest_exchange_wins_under_any_partitioning(spark):
    rows = [("T", ex, D(2001, 5, 1), 10.0 + ex, 12.0 + ex, 9.0, 11.0 + ex, 11.0 + ex, 10 * ex)
            for ex in (3, 1, 2)]
    rows += [("U", 2, D(2001, 5, 1), 5.0, 6.0, 4.0, 5.5, 5.5, 7)]
    df = bars_df(spark, rows)
    one = layers.dedupe_bars(df.repartition(1)).orderBy("ticker").collect()
    many = layers.dedupe_bars(df.repartition(8, "volume")).orderBy("ticker").collect()
    assert one == many
    assert [(r.ticker, r.exchange_id, r.open_price) for r in one] == [("T", 1, 11.0), ("U", 2, 5.0)]
    # bridge keeps every listing (before dedupe) by default, only winners with "kept"
    assert layers.ticker_exchanges(df).count() == 4
    assert layers.ticker_exchanges(df, membership="kept").count() == 2


def test_dedupe_ties_broken_by_values(spark):
    df = spark.createDataFrame([("k", 1, 3.0), ("k", 1, 2.0), ("k", 1, 5.0)], "k string, p int, v double")
    assert dedupe_by_priority(df, ["k"], ["p"]).first().v == 2.0


def test_silver_derivations_and_calendar(spark):
    df = bars_df(spark, [("A", 1, D(2000, 1, 2), 10.0, 12.0, 9.0, 11.0, 11.0, 5)])
    r = layers.silver(df).first()
    assert (r.year, r.month, r.quarter, r.day_of_week) == (2000, 1, 1, 1)  # a Sunday
    assert r.daily_range == 3.0 and r.daily_change == 1.0
    assert abs(r.daily_change_pct - 10.0) < 1e-12


def test_single_day_year_has_null_stddev(spark):
    df = bars_df(spark, [("A", 1, D(2000, 6, 1), 10.0, 12.0, 9.0, 11.0, 11.0, 5)])
    y = layers.yearly_performance(layers.silver(df)).first()
    assert y.stddev_daily_return is None
    assert y.trading_days == 1 and y.positive_days == 1 and y.negative_days == 0
    d = layers.daily_metrics(layers.silver(df)).first()
    assert d.rolling_volatility_30d is None and d.avg_volume_20d is None
    assert d.volume_ratio is None and d.is_volume_spike is None


def monthly_df(spark, rows):
    return spark.createDataFrame(rows, "ticker string, year int, month int, monthly_return_pct double")


def test_streak_across_new_year(spark):
    months = [(2000, 10, -1.0), (2000, 11, 1.0), (2000, 12, 2.0), (2001, 1, 1.0),
              (2001, 2, 1.0), (2001, 3, 0.5), (2001, 4, 0.5), (2001, 5, -2.0)]
    df = monthly_df(spark, [("A", y, m, r) for y, m, r in months])
    r = q.positive_streaks(df).first()
    assert (r.streak_start_year, r.streak_start_month, r.streak_end_year, r.streak_end_month,
            r.consecutive_months) == (2000, 11, 2001, 4, 6)
    r = q.positive_streaks(df, independent_bounds=True).first()
    assert (r.streak_start_month, r.streak_end_month) == (1, 12)


def test_streak_gap_breaks_only_when_adjacency_required(spark):
    months = [(2000, m, 1.0) for m in (1, 2, 3, 5, 6, 7)]
    df = monthly_df(spark, [("A", y, m, r) for y, m, r in months])
    assert q.positive_streaks(df).count() == 1
    assert q.positive_streaks(df, require_adjacent=True).count() == 0
    assert q.positive_streaks(df, min_len=3, require_adjacent=True).count() == 2


def test_recovery_sum_vs_compound(spark):
    df = monthly_df(spark, [("A", 2000, 1, 10.0), ("A", 2000, 2, -50.0), ("A", 2000, 3, 45.0)])
    s = q.recovery_after_drop(df).first()
    assert s.rolling_3month_recovery_pct == 5.0
    # compounded: 1.1 * 0.5 * 1.45 = 0.7975 -> -20.25 %: not a recovery
    assert q.recovery_after_drop(df, compound=True).count() == 0


def test_top_n_keeps_ties(spark):
    yearly = spark.createDataFrame(
        [("A", 2000, 5.0), ("B", 2000, 5.0), ("C", 2000, 4.0), ("D", 2000, 3.0), ("E", 2000, None)],
        "ticker string, year int, yearly_return_pct double")
    bridge = spark.createDataFrame([(t, 1) for t in "ABCDE"], "ticker string, exchange_id int")
    dim = spark.createDataFrame([(1, "x")], "exchange_id int, exchange_name string")
    got = sorted((r.ticker, r.return_rank) for r in
                 q.top_n_per_exchange_year(yearly, bridge, dim, n=2).collect())
    assert got == [("A", 1), ("B", 1)]
    got = q.top_n_per_exchange_year(yearly, bridge, dim, n=3).count()
    assert got == 3


def test_spike_followup_variants(spark):
    rows = [("A", D(2000, 1, d), 2000, 100, 10, 3.0, True if d in (1, 3) else False, float(d))
            for d in range(1, 5)]
    daily = spark.createDataFrame(rows, "ticker string, trade_date date, year int, volume bigint, "
                                        "avg_volume_20d bigint, volume_ratio double, "
                                        "is_volume_spike boolean, daily_change_pct double")
    parity = q.spike_followup(daily).collect()
    assert [(r.trade_date.day, r.next_day_change_pct) for r in parity] == [(1, 3.0)]
    nxt = sorted((r.trade_date.day, r.next_day_change_pct) for r in
                 q.spike_followup(daily, next="trading_day").collect())
    assert nxt == [(1, 2.0), (3, 4.0)]


def test_direction_and_range_position(spark):
    df = spark.createDataFrame([(1.0, 0.5, 9.0), (-1.0, 5.0, 1.0), (None, 3.0, 3.0),
                                (0.0, -0.1, 0.0)], "v double, hi double, lo double")
    got = df.select(direction("v").alias("d"), range_position("hi", "lo").alias("p")).collect()
    assert [(r.d, r.p) for r in got] == [("up", "near_high"), ("down", "near_low"),
                                          ("flat", "neutral"), ("flat", "near_high")]


def test_pack_order_is_lexicographic_and_guarded(spark):
    import itertools

    import pytest

    from tidemark.operators.aggregates import pack_order
    vals_hi = [-(2 ** 61), -5, 0, 3, 2 ** 61 - 1]
    vals_lo = [-(2 ** 63), -1, 0, 7, 2 ** 63 - 1]
    pairs = list(itertools.product(vals_hi, vals_lo))
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [(r.a, r.b) for r in df.orderBy(pack_order("a", "b")).collect()]
    assert got == sorted(pairs)
    g = df.groupBy().agg(F.min_by("b", pack_order("a", "b")).alias("first")).first()
    assert g.first == -(2 ** 63)
    with pytest.raises(Exception):
        spark.createDataFrame([(2 ** 62, 1)], "a bigint, b bigint").select(
            pack_order("a", "b")).collect()


def test_group_mean_methods_agree(spark, sf_small):
    from tidemark.plans.catalog import Layers
    L = Layers(spark, sf_small)
    for fn, args in ((q.worst_vs_own_mean, (L.monthly,)),
                     (q.outperformance_rate, (L.yearly, L.bridge, L.dim)),
                     (q.above_period_mean, (L.daily,))):
        a = sorted(map(tuple, fn(*args, mean_method="join").collect()))
        b = sorted(map(tuple, fn(*args, mean_method="window").collect()))
        assert a == b


def test_session_helpers(spark):
    from tidemark.session import cluster_conf, ensure_checkpoint_dir, scratch_path
    root = ensure_checkpoint_dir(spark)
    assert root and ensure_checkpoint_dir(spark) == root        # an existing setting is kept
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/")
    conf = cluster_conf(100 * 1024 ** 4, executors=1000, cores_per_executor=4)
    # 100 TB read, a twentieth of it shuffled: some thousands of partitions, not one per split
    assert 2 * 4000 <= int(conf["spark.sql.shuffle.partitions"]) <= 25_000
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(10 * 1024 ** 2, executors=2)["spark.sql.shuffle.partitions"]) == 16


def test_compounding_keeps_a_total_loss(spark):
    from tidemark.operators.windows import running_sum
    rows = spark.createDataFrame([("a", 1, 50.0), ("a", 2, -100.0), ("a", 3, 10.0), ("b", 1, None), ("b", 2, 10.0)],
                                 "ticker string, m int, r double")
    out = running_sum(rows, ["ticker"], ["m"], "r", name="c", compound=True)
    got = {(r.ticker, r.m): r.c for r in out.collect()}
    assert [round(got["a", m], 6) for m in (1, 2, 3)] == [50.0, -100.0, -100.0]
    assert got["b", 1] is None and round(got["b", 2], 6) == 10.0
    bad = running_sum(spark.createDataFrame([("a", 1, -101.0)], "ticker string, m int, r double"),
                      ["ticker"], ["m"], "r", name="c", compound=True)
    with pytest.raises(Exception, match="below -100"):
        bad.collect()


def test_dedupe_unknown_exchange_comes_last(spark):
    from tidemark.operators.quality import dedupe_by_priority
    rows = spark.createDataFrame([("AAA", None, 99.0), ("AAA", 1, 11.0), ("BBB", None, 5.0)],
                                 "ticker string, exchange_id int, close double")
    got = {r.ticker: (r.exchange_id, r.close) for r in
           dedupe_by_priority(rows, ["ticker"], ["exchange_id"]).collect()}
    assert got == {"AAA": (1, 11.0), "BBB": (None, 5.0)}


def test_quality_report_counts_nan(spark):
    rows = bars_df(spark, [("A", 1, D(2000, 1, 3), float("nan"), 2.0, 1.0, 1.5, 1.5, 10),
                           ("A", 1, D(2000, 1, 4), 1.5, 2.0, 1.0, None, 1.5, 10)])
    got = quality_report(rows, bar_rules(), measures=["open_price", "close_price"]).first()
    assert (got.total, got.passed, got.nan_open_price, got.nan_close_price) == (2, 1, 1, 0)
