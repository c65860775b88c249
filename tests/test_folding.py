"""The window sink stays small: folding, replays, crashes, readers in between."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import sinks
from tidemark.streaming.sinks import finished_batches, fold_windows, read_latest_windows, read_manifest, upsert_windows

KEYS = ["window_start", "symbol"]
SCHEMA = "window_start timestamp, symbol string, n long"
T0 = dt.datetime(2024, 5, 1, 23, 0)


def batch(spark, *rows):
    return spark.createDataFrame([(T0 + dt.timedelta(minutes=m), s, n) for m, s, n in rows], SCHEMA)


def state(spark, path, since=None):
    return sorted((int((r.window_start - T0).total_seconds() // 60), r.symbol, r.n)
                  for r in read_latest_windows(spark, path, keys=KEYS, since=since).collect())


def batches(spark, path):
    return [b.path for b in finished_batches(spark, path)]


def test_folding_keeps_the_state_and_drops_folders(spark, tmp_path):
    path = str(tmp_path / "sink")
    write = upsert_windows(path, "r")
    assert fold_windows(spark, path, keys=KEYS) is None and read_manifest(spark, path) is None
    write(batch(spark, (0, "a", 1), (0, "b", 1)), 0)
    assert fold_windows(spark, path, keys=KEYS) is None  # the last batch may come again
    write(batch(spark, (0, "a", 2), (90, "a", 1)), 1)
    write(batch(spark, (90, "a", 5)), 2)
    want = [(0, "a", 2), (0, "b", 1), (90, "a", 5)]
    assert state(spark, path) == want
    first = fold_windows(spark, path, keys=KEYS)
    assert first.version == 1 and len(first.base) == 2 and state(spark, path) == want
    assert len(batches(spark, path)) == 3  # superseded, but there for readers at work
    write(batch(spark, (90, "b", 7)), 3)
    want.append((90, "b", 7))
    second = fold_windows(spark, path, keys=KEYS)
    assert state(spark, path) == want and batches(spark, path) == ["run_id=r/batch_id=2", "run_id=r/batch_id=3"]
    assert second.base[dt.date(2024, 5, 1)] == first.base[dt.date(2024, 5, 1)]  # only the changed date was written anew
    assert second.base[dt.date(2024, 5, 2)] != first.base[dt.date(2024, 5, 2)]
    fold_windows(spark, path, keys=KEYS, stopped=True)
    fold_windows(spark, path, keys=KEYS, stopped=True)
    assert state(spark, path) == want
    assert state(spark, path, since="2024-05-02") == want[2:] and state(spark, path, since="2025-01-01") == []
    assert set(read_latest_windows(spark, path, keys=KEYS).columns) == {"window_start", "symbol", "n"}


def test_size_stays_bounded(spark, tmp_path):
    path = str(tmp_path / "sink")
    write = upsert_windows(path, "r", fold_every=3, keys=KEYS)
    sizes = []
    for k in range(15):
        write(batch(spark, (0, "a", k), (k % 2, "b", k)), k)
        sizes.append(len(batches(spark, path)))
    assert max(sizes) <= 7 and state(spark, path) == [(0, "a", 14), (0, "b", 14), (1, "b", 13)]
    assert len(os.listdir(f"{path}/manifest")) <= 4 and len(os.listdir(f"{path}/base")) <= 4


def test_a_replayed_batch_counts_again(spark, tmp_path):
    path = str(tmp_path / "sink")
    write = upsert_windows(path, "r")
    write(batch(spark, (0, "a", 1)), 0)
    write(batch(spark, (0, "a", 2)), 1)
    fold_windows(spark, path, keys=KEYS, stopped=True)
    write(batch(spark, (0, "a", 3)), 1)  # the stream was not done: its last batch comes again
    assert state(spark, path) == [(0, "a", 3)]
    write(batch(spark, (0, "b", 1)), 2)
    fold_windows(spark, path, keys=KEYS)
    fold_windows(spark, path, keys=KEYS)
    assert state(spark, path) == [(0, "a", 3), (0, "b", 1)]


def test_a_new_run_goes_on(spark, tmp_path):
    path = str(tmp_path / "sink")
    upsert_windows(path, "one")(batch(spark, (0, "a", 1), (0, "b", 1)), 41)
    upsert_windows(path, "two")(batch(spark, (0, "a", 2)), 0)
    fold_windows(spark, path, keys=KEYS)
    upsert_windows(path, "two")(batch(spark, (0, "b", 2)), 1)
    fold_windows(spark, path, keys=KEYS)
    assert state(spark, path) == [(0, "a", 2), (0, "b", 2)]


def test_a_folding_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sink")
    write = upsert_windows(path, "r")
    for k in range(3):
        write(batch(spark, (0, "a", k)), k)
    layer = sinks.write_layer

    def dies(*args, **kwargs):
        layer(*args, **kwargs)
        raise RuntimeError("lost")
    monkeypatch.setattr(sinks, "write_layer", dies)
    with pytest.raises(RuntimeError):
        fold_windows(spark, path, keys=KEYS)
    monkeypatch.undo()
    assert read_manifest(spark, path) is None and state(spark, path) == [(0, "a", 2)]
    fold_windows(spark, path, keys=KEYS)
    write(batch(spark, (0, "a", 9)), 3)
    fold_windows(spark, path, keys=KEYS)
    assert state(spark, path) == [(0, "a", 9)] and len(os.listdir(f"{path}/base")) == 2

    # Two that start from one manifest: the second fails at its commit.
    write(batch(spark, (0, "a", 10)), 4)
    held = read_manifest(spark, path)
    fold_windows(spark, path, keys=KEYS)
    write(batch(spark, (0, "a", 11)), 5)
    monkeypatch.setattr(sinks, "read_manifest", lambda *_: held)
    with pytest.raises(Exception, match="already exists"):
        fold_windows(spark, path, keys=KEYS)
    monkeypatch.undo()
    assert state(spark, path) == [(0, "a", 11)]


def test_unfinished_batches_are_not_folded(spark, tmp_path):
    path = str(tmp_path / "sink")
    write = upsert_windows(path, "r")
    for k in range(3):
        write(batch(spark, (0, "a", k)), k)
    os.remove(f"{path}/run_id=r/batch_id=1/_SUCCESS")
    fold_windows(spark, path, keys=KEYS)
    assert [p for p in read_manifest(spark, path).superseded] == ["run_id=r/batch_id=0"]
    assert read_latest_windows(spark, path, keys=KEYS).agg(F.max("n")).first()[0] == 2
