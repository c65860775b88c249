"""Batch sinks: partitioned layer writes, table registration, result exports.

A layer write replaces the whole layer, so a rebuild leaves exactly the rows it
was given; replacing only the partitions at hand is an explicit mode.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import LAYER_TABLES

WRITE_MODES = ("replace", "partitions")


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "replace",
                rebalance: bool = True, max_records_per_file: int | None = None) -> None:
    """Write a Parquet layer.

    mode="replace" (default): the folder holds the rows of ``df`` afterwards
    and nothing else.  mode="partitions": only the partitions that ``df`` has
    rows for are replaced (a backfill of some days or years).

    With ``partition_by`` the rows are rebalanced on the partition columns:
    a task writes few folders, and adaptive execution cuts a partition value
    with many rows (a year of daily metrics) into several tasks by its measured
    size.  ``rebalance=False`` saves that shuffle where the partition columns have
    a handful of values and every task may write its own file for each.
    ``max_records_per_file`` caps file size.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}, not {mode!r}")
    partition_by = list(partition_by)
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if mode == "replace" else "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def register_tables(spark: SparkSession, root: str, database: str = "stock_analytics",
                    names: Sequence[str] | None = None) -> list[str]:
    """Create (or re-create) catalog tables over the layer folders under
    ``root`` and discover their partitions.  Safe to run repeatedly."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    done = []
    for name in names or LAYER_TABLES:
        cols, parts = LAYER_TABLES[name]
        full = f"{database}.{name}"
        all_cols = cols + (", " + parts if parts else "")
        part_names = ", ".join(p.split()[0] for p in parts.split(",")) if parts else ""
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(
            f"CREATE TABLE {full} ({all_cols}) USING PARQUET "
            + (f"PARTITIONED BY ({part_names}) " if parts else "")
            + f"LOCATION '{root.rstrip('/')}/{name}'")
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {full}")
        done.append(full)
    return done


Sink = Callable[[DataFrame, str], None]


def parquet_sink(root: str) -> Sink:
    """Export sink writing each result to ``<root>/<name>`` (overwrite)."""
    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
    return write


def jdbc_sink(url: str, properties: Mapping[str, str]) -> Sink:
    """Export sink replacing a relational table per result (needs the JDBC
    driver on the classpath)."""
    def write(df: DataFrame, name: str) -> None:
        writer = df.write.format("jdbc").option("url", url).option("dbtable", name)
        for key, value in properties.items():
            writer = writer.option(key, value)
        writer.mode("overwrite").save()
    return write


def read_in_order(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """An exported result with the place that each row has in the written order.

    A sorted write numbers its files by range, so the place is a row's index in
    its file after the rows of the files before.  Only the row counts per file (as
    many as the write had tasks) are put in one order.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(files), "_file").withColumn(position, F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before")


def run_exports(exports: Mapping[str, DataFrame], sink: Sink) -> dict[str, int]:
    """Write each result with ``sink``; row counts are observed during the
    write itself instead of re-running the query."""
    counts = {}
    for name, df in exports.items():
        obs = Observation(f"export_{name}")
        sink(df.observe(obs, F.count(F.lit(1)).alias("rows")), name)
        counts[name] = int(obs.get["rows"])
    return counts
