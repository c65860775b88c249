"""Exact deduplication as a stateful stream.

Rows arrive as (digest, stable identifier, content locator: file and row in it).  A Structured
Streaming aggregation keyed by digest keeps, in a disk-backed (RocksDB) state
store without any expiry, the row that stays and the number of arrivals; Spark
combines the arrivals of a digest before the shuffle, so a group of copies of
any size reaches the state as a few rows.  Digests that were hit more than once
are then checked on their full bytes, and texts that merely share a digest are
told apart.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, scratch_dir, ship_package, text_or_empty

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    # Many small stores: without this each one reserves megabytes of disk ahead of its logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
BYTES_PER_BATCH = 256 * 1024 ** 2
# The driver holds one bit for each of so many hash values (1 MB), whatever the input.
BITMAP_BITS = 1 << 23


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def locator(docs: DataFrame) -> list[Column]:
    """File and position in it of each row of Parquet files, whatever their own columns are called."""
    place = docs.metadataColumn("_metadata")
    return [place.getField("file_path").alias("file"), place.getField("row_index").alias("row")]


def arrivals(docs: DataFrame, id_col: str, text_col: str, digest=sha256_digest) -> DataFrame:
    """The narrow arrival log of a table of Parquet files: id, digest, and the row's locator (file, row)."""
    return docs.select(F.col(id_col).alias("id"), digest(text_or_empty(text_col)).alias("digest"), *locator(docs))


def fetch(docs: DataFrame, locators: DataFrame) -> DataFrame:
    """The rows of ``docs``, read from Parquet files, that (file, row) of ``locators`` point to."""
    return _by_locator(docs, locators, "left_semi")


def _by_locator(docs: DataFrame, locators: DataFrame, how: str) -> DataFrame:
    wanted = locators.select(F.col("file").alias("__file"), F.col("row").alias("__row"))
    placed = docs.select(F.struct(*docs.columns).alias("doc"), *locator(docs))
    return placed.join(wanted, (placed["file"] == wanted["__file"]) & (placed["row"] == wanted["__row"]), how).select("doc.*")


def run_state(log: DataFrame, state_dir: str, updates_dir: str, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """Feed a written arrival log through the keyed state; (digest, keeper, n) as it stands at the end.

    ``state_dir`` holds offsets and state: a later call with more files in the
    log continues from there, and a batch that is run again rewrites its own
    folder of updates.  Updates of a digest only ever grow, so the largest wins.
    """
    spark = log.sparkSession
    path = log.inputFiles()[0].rsplit("/", 1)[0] if log.inputFiles() else None
    keeper = F.max(F.struct("id", "file", "row")).alias("keeper")
    shape = log.groupBy("digest").agg(keeper, F.count(F.lit(1)).alias("n"))
    shape.limit(0).write.mode("append").parquet(updates_dir)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates_dir}/batch_id={batch_id}")

    if path:
        before = {key: spark.conf.get(key, None) for key in ROCKSDB}
        try:
            for key, value in ROCKSDB.items():
                spark.conf.set(key, value)
            source = spark.readStream.schema(log.schema).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(path)
            query = (source.groupBy("digest").agg(keeper, F.count(F.lit(1)).alias("n"))
                     .writeStream.outputMode("update").option("checkpointLocation", state_dir)
                     .trigger(availableNow=True).foreachBatch(put).start())
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        query.awaitTermination()
    updates = spark.read.schema(shape.schema).option("recursiveFileLookup", "true").parquet(updates_dir)
    return updates.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("n").alias("n"))


def _bitmap(digests: DataFrame) -> np.ndarray:
    """One bit per hash value that some digest has; at most ``BITMAP_BITS / 64`` numbers reach the driver."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(BITMAP_BITS)).cast("int")
    rows = (digests.select(F.shiftright(bit, 6).alias("word"), (F.lit(1).cast("long")).alias("one"), bit.bitwiseAND(63).alias("at"))
            .select("word", F.expr("shiftleft(one, at)").alias("mask"))
            .groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas())
    words = np.zeros(BITMAP_BITS // 64, np.int64)
    words[rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    return words


def full_byte_variants(docs: DataFrame, text_col: str, hit: DataFrame, digest=sha256_digest) -> DataFrame:
    """Digests among ``hit`` whose rows hold more than one text.

    Only rows whose digest falls on a set bit of a fixed-size bitmap leave the
    scan; equal texts are counted together before the shuffle.
    """
    spark = docs.sparkSession
    words = _bitmap(hit)
    ship_package(spark)

    @F.pandas_udf("boolean")
    def maybe_hit(h: pd.Series) -> pd.Series:
        bit = np.mod(h.to_numpy(), BITMAP_BITS)
        return pd.Series((words[bit >> 6] >> (bit & 63)) & 1 == 1)

    text = text_or_empty(text_col)
    rows = docs.select(digest(text).alias("digest"), text.alias("text"))
    rows = rows.where(maybe_hit(F.xxhash64("digest")))
    texts = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    return texts.groupBy("digest").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1").select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest,
                bytes_per_batch: int = BYTES_PER_BATCH, in_files: bool = False, state_dir: str | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, digest, file, row, keep_file, keep_row): one row per input row.

    Of equal texts the row with the largest id stays; of repeated rows with
    that id, one.  A null text counts as empty, a null id is smaller than any
    other; an empty table gives an empty one; other columns are ignored.
    ``digest`` may be any function of the text: a weaker one costs time, not
    correctness.

    ``in_files`` says that ``docs`` is read from Parquet files, with every row a
    row of its own there; locators then point into those files.  Without it,
    ids and texts are written once and locators point to what was written.

    ``state_dir`` (a shared folder) makes the call an arrival at a lasting state:
    contents, log and state are kept there, and the answer covers all rows
    that ever arrived, as one call with all of them would.
    """
    spark: SparkSession = docs.sparkSession
    if state_dir or not in_files:
        contents = f"{state_dir}/contents" if state_dir else scratch_dir(spark, "dedup-contents")
        texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
        here = f"{contents}/arrival={uuid.uuid4().hex}"
        texts.write.parquet(here)
        docs, id_in, text_in = spark.read.schema(texts.schema).parquet(here), "id", "text"
    else:
        id_in, text_in = id_col, text_col
    new = arrivals(docs, id_in, text_in, digest)
    if state_dir:
        new.write.mode("append").parquet(f"{state_dir}/log")
        log = spark.read.schema(new.schema).parquet(f"{state_dir}/log")
        docs = spark.read.schema(docs.schema).option("recursiveFileLookup", "true").parquet(contents)
        folders = f"{state_dir}/state", f"{state_dir}/updates"
    else:
        log = materialize(new, "arrivals")
        folders = scratch_dir(spark, "dedup-state"), scratch_dir(spark, "dedup-updates")
    state = materialize(run_state(log, *folders, bytes_per_batch), "dedup-table")
    shared = materialize(full_byte_variants(docs, text_in, state.where("n > 1").select("digest"), digest), "digest-collisions")
    collisions = not shared.isEmpty()
    found = _answer(log.join(shared, "digest", "left_anti") if collisions else log, state, ["digest"], id_col)
    if collisions:
        found = found.unionByName(_by_text(docs, id_col, text_in, log, shared))
    return found


def _answer(log: DataFrame, groups: DataFrame, key: list[str], id_col: str) -> DataFrame:
    return log.join(groups, key).select(
        F.col("id").alias(id_col), F.col("keeper.id").alias("keep_id"), F.col("n").alias("group_size"),
        ((F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))).alias("kept"), "digest",
        "file", "row", F.col("keeper.file").alias("keep_file"), F.col("keeper.row").alias("keep_row"))


def _by_text(docs: DataFrame, id_col: str, text_col: str, log: DataFrame, shared: DataFrame) -> DataFrame:
    """The same answer for digests that several texts share, keyed by the texts, which the locators fetch."""
    hits = materialize(log.join(shared, "digest", "left_semi"), "collided-log")
    texts = docs.select(text_or_empty(text_col).alias("text"), *locator(docs))
    rows = materialize(hits.join(texts, ["file", "row"]), "collided-rows")
    best = F.max(F.struct("id", "file", "row")).alias("keeper")
    groups = materialize(rows.groupBy("digest", "text").agg(best, F.count(F.lit(1)).alias("n")), "collided-groups")
    return _answer(rows, groups, ["digest", "text"], id_col)


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; ``found`` is of ``exact_dedup(docs, in_files=True)``.

    The rows that go are written as locators; where they are few, Spark sends
    them to the scan and no text is shuffled.
    """
    return _by_locator(docs, materialize(found.where("NOT kept").select("file", "row"), "dropped"), "left_anti")
