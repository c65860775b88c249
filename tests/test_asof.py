"""As-of enrichment: batch against a plain loop, stream against batch."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import questions as sq
from tidemark.streaming.asof import as_of
from tidemark.streaming.runner import rocksdb_state, start_append

T0 = dt.datetime(2024, 3, 1, 9, 30, tzinfo=dt.timezone.utc)
EVENTS = "k string, at timestamp, n long"
VERSIONS = "k string, since timestamp, level double, tags array<string>"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def made(seed):
    rng = random.Random(seed)
    events = [(rng.choice(["a", "a", "a", "b", "c"]), rng.uniform(0, 3600), n) for n in range(400)]
    versions = [(k, s, rng.random(), [k, "all"][:rng.randint(0, 2)]) for k in "abd" for s in rng.sample(range(0, 3600, 7), 6)]
    return events + [("a", versions[0][1], 900), ("a", versions[0][1] - 1e-6, 901)], versions


def frames(spark, events, versions):
    return (spark.createDataFrame([(k, at(s), n) for k, s, n in events], EVENTS),
            spark.createDataFrame([(k, at(s), v, t) for k, s, v, t in versions], VERSIONS))


def plain(events, versions):
    out = []
    for k, s, n in events:
        held = [v for v in versions if v[0] == k and at(v[1]) <= at(s)]
        if held:
            _, _, level, tags = max(held, key=lambda v: v[1])
            out.append((k, n, level, tuple(tags)))
    return sorted(out)


def rows(df):
    return sorted((r.k, r.n, r.level, tuple(r.tags)) for r in df.collect())


@pytest.mark.parametrize("salts", [1, 8])
def test_batch(spark, salts):
    events, versions = made(1)
    e, v = frames(spark, events, versions)
    e = e.unionByName(spark.createDataFrame([(None, T0, 1), ("a", None, 2)], EVENTS))
    v = v.unionByName(spark.createDataFrame([(None, T0, 1.0, []), ("b", None, 2.0, [])], VERSIONS))
    assert rows(as_of(e, v, "k", "at", "since", ["level", "tags"], salts=salts)) == plain(events, versions)
    assert as_of(e.limit(0), v, "k", "at", "since", ["level"]).count() == 0
    assert as_of(e, v.limit(0), "k", "at", "since", ["level"]).count() == 0


def test_sides_must_agree(spark):
    e, v = frames(spark, *made(2))
    stream = spark.readStream.format("rate").load().select(F.lit("a").alias("k"), F.col("timestamp").alias("at"), F.col("value").alias("n"))
    with pytest.raises(ValueError):
        as_of(stream, v, "k", "at", "since", ["level"])
    versions = stream.select("k", F.col("at").alias("since"), F.col("n").alias("level"))
    with pytest.raises(ValueError):
        as_of(stream, versions, "k", "at", "since", ["level"])


def test_stream_waits_for_versions_and_survives_restarts(spark, tmp_path):
    """Within a slice rows come in any order; a version that is late is dropped, as is a late event."""
    events, versions = made(3)
    e_dir, v_dir, out, ckpt = (str(tmp_path / n) for n in ("events", "versions", "out", "checkpoint"))
    for k, (low, high) in enumerate(((0, 1500), (1500, 2000), (2000, 3600))):
        e, v = frames(spark, [x for x in events if low <= x[1] < high], [x for x in versions if low <= x[1] < high])
        if k == 2:
            late = frames(spark, [("a", 10, 990)], [("a", 11, -1.0, [])])
            e, v = e.unionByName(late[0]), v.unionByName(late[1])
        e.write.mode("append").parquet(e_dir)
        v.write.mode("append").parquet(v_dir)
        with rocksdb_state(spark):
            met = as_of(spark.readStream.schema(EVENTS).parquet(e_dir), spark.readStream.schema(VERSIONS).parquet(v_dir),
                        "k", "at", "since", ["level", "tags"], delay="1 minute", salts=2)
            query = start_append(met, out, ckpt)
        query.awaitTermination()
        assert query.exception() is None
    seen = max(max(s for _, s, _ in events), max(v[1] for v in versions))
    reached = int((seen - 60) * 1000) / 1000
    assert rows(spark.read.parquet(out)) == plain([e for e in events if e[1] <= reached], versions)


def test_sentiment_of_a_refreshed_snapshot(spark):
    trades = spark.createDataFrame([("x", 10.0, at(5)), ("x", 10.0, at(65)), ("x", 12.0, at(66)), ("y", 3.0, at(66)), ("x", 0.0, at(67))],
                                   "symbol string, price double, event_time timestamp")
    snapshots = spark.createDataFrame([("x", ["N"], 9.0, at(0)), ("x", ["N", "M"], 11.0, at(60)), ("x", ["N"], None, at(61)),
                                       ("y", ["N"], 3.0, at(0))], "symbol string, exchange array<string>, prev_close double, valid_from timestamp")
    got = sorted((r.window_start.minute, r.exchange, r.rising_count, r.falling_count, r.sentiment_ratio)
                 for r in sq.market_sentiment_as_of(trades, snapshots).collect())
    assert got == [(30, "N", 1, 0, 1.0), (31, "M", 1, 1, 0.5), (31, "N", 1, 1, 0.5)]


def test_closed_windows_need_a_known_mode(spark):
    e, _ = frames(spark, *made(2))
    with pytest.raises(ValueError):
        sq.market_sentiment(e, e, emit="append")
