"""Idempotent sinks for windowed stream results.

In update mode a window is emitted again every time it changes.  Appending
those rows into a table keyed by (window, key) either violates the key or
keeps stale partial values.  ``upsert_windows`` writes each micro-batch to its
own folder, ``run_id=<run>/batch_id=<n>``, with overwrite: a replayed batch
(after a failure between the write and the checkpoint commit) replaces its own
output, and a new checkpoint, whose batch numbers begin again, is a new run and
leaves earlier results alone.  ``read_latest_windows`` resolves every (window,
key) to the row that was written last; ``compact_windows`` keeps a table of
those rows by day.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import STREAM_MARTS
from tidemark.sources import folders
from tidemark.sources.sinks import write_layer

BatchFn = Callable[[DataFrame, int], None]
COMMITTED = "_committed"


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run a checkpoint belongs to; made up and kept beside the
    stream's own files when the checkpoint is first used."""
    path = f"{checkpoint.rstrip('/')}/tidemark-run"
    try:
        kept = spark.read.text(path).first()
        if kept:
            return kept[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    run = uuid.uuid4().hex
    spark.createDataFrame([(run,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return run


def upsert_windows(path: str, run_id: str, fold_every: int | None = None, question: str | None = None,
                   keys: Sequence[str] | None = None) -> BatchFn:
    """foreachBatch function: write the batch, with the time it was written,
    under ``<path>/run_id=<run_id>/batch_id=<id>``.

    With ``fold_every`` the folders so far are folded after every so many batches
    (``question`` or ``keys`` as in ``fold_windows``).
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(COMMITTED, F.current_timestamp())
         .write.mode("overwrite").parquet(f"{root}/run_id={run_id}/batch_id={batch_id}"))
        if fold_every and batch_id % fold_every == fold_every - 1:
            fold_windows(batch.sparkSession, path, question, keys)
    return write


def _keys(question: str | None, keys: Sequence[str] | None) -> list[str]:
    if (question is None) == (keys is None):
        raise ValueError("give either question or keys")
    return list(keys or STREAM_MARTS[question][1])


def _last_written(rows: DataFrame, keys: list[str], with_origin: bool = False) -> DataFrame:
    """Per key the row that was written last.  One aggregate, partial per map task."""
    own = {"run_id", "batch_id", COMMITTED}
    rest = [c for c in rows.columns if c not in keys and (with_origin and c != "run_id" or c not in own)]
    latest = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(COMMITTED, "batch_id")).alias("_row")
    return rows.groupBy(*keys).agg(latest).select(*keys, "_row.*")


def read_latest_windows(spark: SparkSession, path: str, question: str | None = None,
                        keys: Sequence[str] | None = None, since: str | None = None) -> DataFrame:
    """Current value of every (window, key): the row that was written last.

    The keys are those of ``question`` in ``schemas.STREAM_MARTS``, or given
    outright.  ``since`` leaves out windows that begin before it; the filter
    reaches the scan, and base dates before it are not listed.  One aggregate,
    partial per map task.
    """
    keys, root = _keys(question, keys), path.rstrip("/")
    manifest = read_manifest(spark, path)
    if manifest is None:
        df = spark.read.option("basePath", path).parquet(f"{root}/run_id=*")
    else:
        first = dt.date.fromisoformat(since[:10]) if since else dt.date.min
        base = _read_base(spark, root, {d: g for d, g in manifest.base.items() if d >= first})
        fresh = [b.path for b in finished_batches(spark, path) if manifest.superseded.get(b.path) != b.written_ms]
        parts = ([spark.read.option("basePath", root).parquet(*[f"{root}/{p}" for p in fresh]).drop("run_id")] if fresh else []) \
            + ([base] if base is not None else [])
        if not parts:  # nothing at or after ``since``: an empty frame of the base's columns
            parts = [_read_base(spark, root, dict(list(manifest.base.items())[:1]))]
        df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if since is not None:
        df = df.filter(F.col("window_start") >= F.lit(since).cast(df.schema["window_start"].dataType))
    return _last_written(df, keys)


class Batch(NamedTuple):
    path: str  # below the sink's folder
    written_ms: int


class Manifest(NamedTuple):
    version: int
    base: dict[dt.date, str]  # window date -> generation in force
    superseded: dict[str, int]  # path below the sink's folder -> when it was written


MANIFEST = "kind string, window_date date, generation string, path string, written_ms long"


def finished_batches(spark: SparkSession, path: str) -> list[Batch]:
    """Batch folders whose write is complete, in the order they were written."""
    root, found = path.rstrip("/"), []
    for run in folders.entries(spark, root):
        if run.name.startswith("run_id="):
            for batch in folders.entries(spark, f"{root}/{run.name}"):
                written = folders.written_at(spark, f"{root}/{run.name}/{batch.name}")
                if batch.name.startswith("batch_id=") and written is not None:
                    found.append(Batch(f"{run.name}/{batch.name}", written))
    return sorted(found, key=lambda b: (b.written_ms, b.path))


def read_manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The newest complete manifest; None where nothing has been folded."""
    root = f"{path.rstrip('/')}/manifest"
    versions = sorted((int(e.name.split("=")[1]) for e in folders.entries(spark, root) if e.name.startswith("version=")), reverse=True)
    for version in versions:
        if folders.written_at(spark, f"{root}/version={version}") is not None:
            rows = spark.read.schema(MANIFEST).parquet(f"{root}/version={version}").collect()
            return Manifest(version, {r.window_date: r.generation for r in rows if r.kind == "base"},
                            {r.path: r.written_ms for r in rows if r.kind == "superseded"})
    return None


def _read_base(spark: SparkSession, root: str, base: dict[dt.date, str]) -> DataFrame | None:
    paths = [f"{root}/base/generation={g}/window_date={d.isoformat()}" for d, g in sorted(base.items())]
    return spark.read.option("basePath", f"{root}/base").parquet(*paths).drop("generation", "window_date") if paths else None


def fold_windows(spark: SparkSession, path: str, question: str | None = None, keys: Sequence[str] | None = None,
                 stopped: bool = False) -> Manifest | None:
    """Fold the finished batch folders into the base; the manifest then in force.

    The batch written last is left alone, as a stream that failed right after it
    writes it again; with ``stopped=True`` (the stream is done) it is folded too.
    One folding at a time: a second one that starts from the same manifest fails
    at its commit and changes nothing.  A folding that dies before its commit
    leaves a generation that no manifest names; a later one removes it.
    """
    keys, root = _keys(question, keys), path.rstrip("/")
    manifest = read_manifest(spark, path) or Manifest(0, {}, {})
    batches = [b for b in finished_batches(spark, path) if manifest.superseded.get(b.path) != b.written_ms]
    folded = batches if stopped else batches[:-1]
    if not folded:
        return manifest if manifest.version else None
    _remove_superseded(spark, root, manifest)
    version = manifest.version + 1
    generation = f"{version}-{uuid.uuid4().hex[:8]}"

    fresh = spark.read.option("basePath", root).parquet(*[f"{root}/{b.path}" for b in folded]).drop("run_id")
    dates = [r.d for r in fresh.select(F.to_date("window_start").alias("d")).distinct().collect()]
    held = {d: manifest.base[d] for d in dates if d in manifest.base}
    base = _read_base(spark, root, held)
    merged = _last_written(fresh if base is None else fresh.unionByName(base), keys, with_origin=True)
    write_layer(merged.withColumn("window_date", F.to_date("window_start")), f"{root}/base/generation={generation}",
                partition_by=["window_date"])

    superseded = {b.path: b.written_ms for b in folded} | {
        f"base/generation={g}/window_date={d.isoformat()}": 0 for d, g in held.items()}
    now = manifest.base | {d: generation for d in dates}
    rows = [("base", d, g, None, None) for d, g in now.items()] + [("superseded", None, None, p, ms) for p, ms in superseded.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/version={version}")
    return Manifest(version, now, superseded)


def _remove_superseded(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Remove what the manifest in force superseded, earlier manifests, and
    generations of foldings that never came to their commit."""
    for path, written_ms in manifest.superseded.items():
        # A batch that was written again since then is a new one.
        if path.startswith("base/") or folders.written_at(spark, f"{root}/{path}") == written_ms:
            folders.remove(spark, f"{root}/{path}")
    for entry in folders.entries(spark, f"{root}/manifest"):
        if entry.name.startswith("version=") and int(entry.name.split("=")[1]) < manifest.version:
            folders.remove(spark, f"{root}/manifest/{entry.name}")
    named = set(manifest.base.values())
    for entry in folders.entries(spark, f"{root}/base"):
        generation = entry.name.removeprefix("generation=")
        if generation not in named and int(generation.split("-")[0]) <= manifest.version:
            folders.remove(spark, f"{root}/base/{entry.name}")


def compact_windows(spark: SparkSession, path: str, mart: str, question: str,
                    since: str | None = None) -> None:
    """Write the current windows to ``mart``, partitioned by window date.

    Without ``since`` the whole table is replaced; with it (a date) only the
    days from there on are read and replaced, which is what a daily job needs
    once older windows are closed.
    """
    latest = read_latest_windows(spark, path, question, since=since)
    write_layer(latest.withColumn("window_date", F.to_date("window_start")), mart,
                partition_by=["window_date"], mode="partitions" if since else "replace")
