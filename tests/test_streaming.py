"""Stream questions on a file-backed stream equal their batch twins; late
data is dropped; replaying a micro-batch does not duplicate output."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import layers
from tidemark.sources import fixtures
from tidemark.sources.stream import (
    decode_trades, flatten_trade_envelopes, trade_payloads, trade_stream,
)
from tidemark.streaming import questions as sq
from tidemark.streaming.runner import start_append, start_enriched, start_upsert
from tidemark.streaming.sinks import (
    compact_windows, read_latest_windows, run_id_of, upsert_windows,
)

KEYS = ["window_start", "window_end", "symbol"]


def write_message_files(spark, trades, folder):
    """Write trades as JSON lines, one file per day, with increasing mtimes so
    the file source replays them in time order."""
    os.makedirs(folder, exist_ok=True)
    payloads = trade_payloads(trades.withColumn("d", F.to_date("event_time")))
    rows = (trades.select("symbol", "price", "timestamp_ms", "volume",
                          F.to_date("event_time").alias("d"))
            .orderBy("timestamp_ms").collect())   # tiny fixture, test side only
    by_day = {}
    for r in rows:
        by_day.setdefault(r.d, []).append(json.dumps(
            {"symbol": r.symbol, "price": r.price, "timestamp_ms": r.timestamp_ms,
             "volume": r.volume}))
    for i, (day, lines) in enumerate(sorted(by_day.items())):
        path = os.path.join(folder, f"trades-{day.isoformat()}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    assert payloads.columns == ["key", "value"]
    return len(by_day)


def stream_of(spark, folder, files_per_batch=3):
    raw = trade_stream(spark, "text", folder, {"maxFilesPerTrigger": str(files_per_batch)})
    return decode_trades(raw)


def sorted_rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def feed(spark, sf_small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("feed"))
    trades = fixtures.trades(spark, sf_small)
    write_message_files(spark, trades, folder)
    batch = decode_trades(spark.read.text(folder))
    return folder, batch


def run_upsert(spark, result, tmp_path, name):
    out, ckpt = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-ckpt")
    q = start_upsert(result, out, ckpt, name=name)
    q.awaitTermination(300)
    assert q.exception() is None
    return read_latest_windows(spark, out, name[:3])


def test_sq1_stream_equals_batch(spark, feed, tmp_path):
    folder, batch = feed
    got = run_upsert(spark, sq.price_volatility(stream_of(spark, folder)), tmp_path, "sq1")
    want = sq.price_volatility(batch)
    assert got.count() == 23
    assert sorted_rows(got) == sorted_rows(want)


def test_sq3_stream_equals_batch(spark, feed, tmp_path):
    folder, batch = feed
    got = run_upsert(spark, sq.trade_frequency(stream_of(spark, folder), baseline=1),
                     tmp_path, "sq3")
    assert sorted_rows(got) == sorted_rows(sq.trade_frequency(batch, baseline=1))
    assert got.count() == 977


def test_sq4_sq5_sq2_stream_static_join(spark, sf_small, feed, tmp_path):
    folder, batch = feed
    quotes = fixtures.daily_quotes(spark, sf_small)
    snapshot, baselines = layers.latest_snapshot(quotes), layers.quote_baselines(quotes)
    got4 = run_upsert(spark, sq.price_vs_range(stream_of(spark, folder), baselines), tmp_path, "sq4")
    assert sorted_rows(got4) == sorted_rows(sq.price_vs_range(batch, baselines))
    assert got4.count() == 987
    got5 = run_upsert(spark, sq.vs_prev_close(stream_of(spark, folder), snapshot), tmp_path, "sq5")
    assert sorted_rows(got5) == sorted_rows(sq.vs_prev_close(batch, snapshot))
    assert got5.count() == 1000
    got2 = run_upsert(spark, sq.market_sentiment(stream_of(spark, folder), snapshot),
                      tmp_path, "sq2")
    assert sorted_rows(got2) == sorted_rows(sq.market_sentiment(batch, snapshot))
    assert got2.count() == 1978


def test_append_mode_emits_only_closed_windows(spark, feed, tmp_path):
    folder, batch = feed
    out, ckpt = str(tmp_path / "app-out"), str(tmp_path / "app-ckpt")
    q = start_append(sq.trade_frequency(stream_of(spark, folder), baseline=1), out, ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    # closed = window end at or before the final watermark (max event time - 5 min)
    wm = batch.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=5)
    want = sq.trade_frequency(batch, baseline=1).filter(F.col("window_end") <= F.lit(wm))
    assert sorted_rows(got) == sorted_rows(want)


def test_late_event_is_dropped(spark, tmp_path):
    folder = str(tmp_path / "late")
    os.makedirs(folder)
    base = int(dt.datetime(2024, 1, 1, 10, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    minute = 60_000
    # Spark drops an event as late once the watermark of the *previous* batch
    # has passed it, so the late event comes two batches after the jump.
    files_ = [
        [("S", 10.0, base + 1 * minute), ("S", 12.0, base + 2 * minute)],
        [("S", 11.0, base + 120 * minute)],          # watermark -> 11:55 after this batch
        [("S", 11.5, base + 121 * minute)],          # 10:00-10:10 evicted here
        [("S", 99.0, base + 5 * minute),             # late for 10:00-10:10: dropped
         ("S", 13.0, base + 122 * minute)],          # in time: merged
    ]
    for i, rows in enumerate(files_):
        path = os.path.join(folder, f"f{i}.json")
        with open(path, "w") as fh:
            fh.write("\n".join(json.dumps({"symbol": s, "price": p, "timestamp_ms": t,
                                           "volume": 1.0}) for s, p, t in rows) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    result = sq.trade_frequency(stream_of(spark, folder, files_per_batch=1), baseline=1)
    got = {r.window_start.hour * 60 + r.window_start.minute: r.trade_count
           for r in run_upsert(spark, result, tmp_path, "sq3-late").collect()}
    assert got == {600: 2, 720: 3}


def test_upsert_replay_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "upsert")
    fn = upsert_windows(path, "r1")
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    t1 = t0 + dt.timedelta(minutes=10)
    first = spark.createDataFrame([(t0, t1, "S", 2)], "window_start timestamp_ntz, "
                                  "window_end timestamp_ntz, symbol string, trade_count bigint")
    update = first.withColumn("trade_count", F.lit(5).cast("bigint"))
    fn(first, 0)
    fn(update, 1)
    fn(update, 1)   # replay of batch 1 after a failure
    got = read_latest_windows(spark, path, "sq3").collect()
    assert [(r.symbol, r.trade_count) for r in got] == [("S", 5)]
    assert spark.read.parquet(path).count() == 2
    # a new checkpoint counts from 0 again: its batches are newer and replace nothing
    again = upsert_windows(path, "r2")
    again(first.withColumn("trade_count", F.lit(7).cast("bigint")), 0)
    again(first.withColumn("symbol", F.lit("T")), 1)
    got = sorted((r.symbol, r.trade_count) for r in read_latest_windows(spark, path, "sq3").collect())
    assert got == [("S", 7), ("T", 2)]
    assert spark.read.parquet(path).count() == 4


def test_run_id_stays_with_the_checkpoint(spark, tmp_path):
    a = run_id_of(spark, str(tmp_path / "a"))
    assert run_id_of(spark, str(tmp_path / "a")) == a != run_id_of(spark, str(tmp_path / "b"))


def test_compaction_by_day(spark, tmp_path):
    path, mart = str(tmp_path / "win"), str(tmp_path / "mart")
    rows = [(dt.datetime(2024, 1, d, 10), dt.datetime(2024, 1, d, 11), "S", d) for d in (1, 2, 3)]
    frame = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, "
                                  "symbol string, trade_count int")
    write = upsert_windows(path, "r1")
    write(frame, 0)
    compact_windows(spark, path, mart, "sq3")
    write(frame.where("trade_count = 3").withColumn("trade_count", F.lit(30)), 1)
    compact_windows(spark, path, mart, "sq3", since="2024-01-03")
    assert sorted(r.trade_count for r in spark.read.parquet(mart).collect()) == [1, 2, 30]


def test_envelope_edge_cases(spark):
    msgs = [
        {"type": "trade", "data": [{"s": "A", "p": 1.5, "t": 1000, "v": 2.0},
                                   {"s": "B", "p": 2.5, "t": 2000}]},
        {"type": "ping"},
        {"type": "trade", "data": []},
        {"type": "trade", "data": [{"s": None, "p": 1.0, "t": 3000, "v": 1.0}]},
    ]
    raw = spark.createDataFrame([(json.dumps(m),) for m in msgs] + [("{not json",)], "value string")
    got = sorted((r.symbol, r.price, r.volume) for r in flatten_trade_envelopes(raw).collect())
    assert got == [("A", 1.5, 2.0), ("B", 2.5, 0.0)]
    decoded = decode_trades(spark.createDataFrame([("{bad",), ('{"symbol":"A","price":0}',)],
                                                  "value string"))
    assert decoded.count() == 2
    assert sq.valid_trades(decoded, None).count() == 0


def test_snapshot_edge_cases(spark):
    trades = spark.createDataFrame(
        [("A", 10.0, dt.datetime(2024, 1, 1, 10, 0, 5)), ("B", 5.0, dt.datetime(2024, 1, 1, 10, 0, 6))],
        "symbol string, price double, event_time timestamp_ntz")
    snap = spark.createDataFrame(
        [("A", 9.0, []), ("B", 6.0, None)],
        "symbol string, prev_close double, exchange array<string>")
    assert sq.market_sentiment(trades, snap).count() == 0       # empty / NULL listings
    empty = snap.limit(0)
    assert sq.vs_prev_close(trades, empty).count() == 0          # no snapshot at all
    got = sq.vs_prev_close(trades, snap).orderBy("symbol").collect()
    assert [(r.symbol, r.direction) for r in got] == [("A", "up"), ("B", "down")]


def test_whole_windows_with_a_fresh_snapshot(spark, tmp_path):
    """The snapshot is swapped between two micro-batches that share a window:
    the window is complete and judged by the new value."""
    folder = str(tmp_path / "msgs")
    os.makedirs(folder)
    base = int(dt.datetime(2024, 1, 1, 10, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    for i, price in enumerate((10.0, 14.0)):
        path = os.path.join(folder, f"f{i}.json")
        with open(path, "w") as fh:
            fh.write(json.dumps({"symbol": "S", "price": price, "timestamp_ms": base + i * 1000, "volume": 1.0}) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    closes = [20.0]

    def snapshot():
        close = closes.pop() if closes else 6.0
        return spark.createDataFrame([("S", close)], "symbol string, prev_close double")

    out = str(tmp_path / "out")
    qy = start_enriched(sq.mean_price(stream_of(spark, folder, files_per_batch=1), "1 minute", "2 minutes"),
                        sq.enrich_prev_close, snapshot, out, str(tmp_path / "ckpt"))
    qy.awaitTermination(300)
    assert qy.exception() is None
    got = read_latest_windows(spark, out, "sq5").collect()
    assert [(r.current_price, r.prev_close, r.direction) for r in got] == [(12.0, 6.0, "up")]


def test_sq3_symbol_baseline_on_a_stream(spark, feed, tmp_path):
    folder, batch = feed
    base = sq.window_count_baseline(batch)          # history: the batch form of the feed
    got = run_upsert(spark, sq.trade_frequency(stream_of(spark, folder), baseline=base,
                                               factor=1.5), tmp_path, "sq3b")
    want = sq.trade_frequency(batch, baseline=base, factor=1.5)
    assert sorted_rows(got) == sorted_rows(want)
    assert got.filter(F.col("is_high_frequency")).count() > 0


def test_envelopes_on_a_stream_feed_sq1(spark, sf_small, tmp_path):
    """Provider envelopes arriving as files -> flatten -> SQ1, equal to SQ1 on
    the same trades decoded in batch."""
    from tidemark.sources.stream import trade_envelopes

    folder = str(tmp_path / "env")
    trades = fixtures.trades(spark, sf_small)
    trade_envelopes(trades).write.mode("overwrite").text(folder)
    stream = flatten_trade_envelopes(trade_stream(spark, "text", folder,
                                                  {"maxFilesPerTrigger": "1"}))
    got = run_upsert(spark, sq.price_volatility(stream), tmp_path, "sq1-env")
    want = sq.price_volatility(flatten_trade_envelopes(spark.read.text(folder)))
    assert sorted_rows(got) == sorted_rows(want) and got.count() > 0
