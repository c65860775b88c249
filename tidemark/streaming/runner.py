"""Start stream questions against a sink.

The caller always names the checkpoint location (a shared, durable folder on
a cluster); nothing defaults to a machine-local temp folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.sinks import run_id_of, upsert_windows


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, which as-of enrichment needs."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def _start(result: DataFrame, batch_fn, checkpoint: str, trigger: str | None, name: str | None) -> StreamingQuery:
    writer = (result.writeStream.outputMode("update").foreachBatch(batch_fn)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def start_upsert(result: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 name: str | None = None, fold_every: int | None = None,
                 question: str | None = None) -> StreamingQuery:
    """Update mode: every changed window goes to ``path`` through the
    idempotent batch-folder sink (read back with ``read_latest_windows``).  With
    ``fold_every`` and ``question`` the sink folds itself after so many batches."""
    run = run_id_of(result.sparkSession, checkpoint)
    return _start(result, upsert_windows(path, run, fold_every, question), checkpoint, trigger, name)


def start_append(result: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                 name: str | None = None) -> StreamingQuery:
    """Append mode into a Parquet file sink: each window is written once,
    when the watermark closes it (exactly-once through the sink's log)."""
    writer = (result.writeStream.outputMode("append").format("parquet")
              .option("path", path).option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, trigger).start()


def start_enriched(windows: DataFrame, enrich: Callable[[DataFrame, DataFrame], DataFrame],
                   static: Callable[[], DataFrame], path: str, checkpoint: str,
                   trigger: str | None = None, name: str | None = None) -> StreamingQuery:
    """Whole windows with a fresh static side.

    ``windows`` is the stateful part of a question (such as
    ``questions.mean_price``), so a window that spans micro-batches is complete;
    ``enrich(windows, static frame)`` runs on each batch of changed windows,
    with ``static()`` resolved again every time, so a refreshed snapshot is used
    without a restart.  A window is judged by the snapshot of the last batch
    that changed it.  (SQ2 compares trade by trade before its aggregate: its
    snapshot is the one bound when the query starts.)
    """
    write = upsert_windows(path, run_id_of(windows.sparkSession, checkpoint))

    def run(batch: DataFrame, batch_id: int) -> None:
        write(enrich(batch, static()), batch_id)

    return _start(windows, run, checkpoint, trigger, name)
