"""Shards of near equal size by sampled splitters.

Keys are sampled with probability proportional to their rows' sizes, the
sample's quantiles cut the key space into many more ranges than shards, and
the ranges are counted exactly.  An overfull range is sampled again on its own
and cut further; a key that is itself too large becomes a range of its own.
The ranges, largest first, then go to the emptiest shard.  Rows with equal keys
stay in one shard unless that key alone is larger than a shard's share.

The driver holds splitters, range totals and a sample, all bounded by the
number of shards times the parameters below, whatever the input.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ship_package

# No task numbers more rows than this, and the driver holds one offset for as many.
PART_ROWS = 1_000_000
RANGES_PER_SHARD = 64
SAMPLES_PER_RANGE = 32
OVERFULL = 2.0
MAX_ROUNDS = 12


@dataclass
class Splitters:
    """Range boundaries (a key belongs to the range after the last boundary not
    above it) and the heavy keys that stand alone, each in some pieces."""

    bounds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    heavy: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pieces: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def unit(self, key: np.ndarray, tie: np.ndarray) -> np.ndarray:
        out = np.searchsorted(self.bounds, key, side="right")
        if len(self.heavy):
            at = np.minimum(np.searchsorted(self.heavy, key), len(self.heavy) - 1)
            first = len(self.bounds) + 1 + np.r_[0, np.cumsum(self.pieces)[:-1]]
            out = np.where(self.heavy[at] == key, first[at] + tie % self.pieces[at], out)
        return out

    @property
    def units(self) -> int:
        return len(self.bounds) + 1 + int(self.pieces.sum())


def _unit_column(split: Splitters) -> Column:
    @F.pandas_udf("int")
    def unit(key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(split.unit(key.to_numpy(np.int64), tie.to_numpy(np.int64)).astype(np.int32))
    return unit("key", "tie")


def _sampled_bounds(rows: DataFrame, step: float, ranges: int) -> np.ndarray:
    """Quantiles of the keys by size, from a sample of about (sum of sizes) / step rows.

    A row is drawn with probability size / step; one larger than the step is
    drawn for sure and stands for its whole size.
    """
    unit = F.shiftrightunsigned(F.xxhash64(F.lit("draw"), "key", "tie"), 11) / F.lit(float(1 << 53))
    drawn = rows.where(unit < F.col("size") / F.lit(step)) \
                .select("key", F.greatest("size", F.lit(step)).alias("w")).toPandas().sort_values("key")
    if not len(drawn):
        return np.zeros(0, np.int64)
    cum = drawn["w"].cumsum().to_numpy()
    picks = np.searchsorted(cum, np.arange(1, ranges) * (cum[-1] / ranges))
    return np.unique(drawn["key"].to_numpy(np.int64)[np.minimum(picks, len(cum) - 1)])


def find_splitters(rows: DataFrame, total: int, shards: int) -> Splitters:
    ranges = shards * RANGES_PER_SHARD
    target = max(1.0, total / ranges)
    step = target / SAMPLES_PER_RANGE
    split = Splitters(_sampled_bounds(rows, step, ranges))
    for _ in range(MAX_ROUNDS):
        placed = rows.withColumn("unit", _unit_column(split))
        light = len(split.bounds) + 1
        sums = placed.groupBy("unit").agg(F.sum("size").alias("size")).where(F.col("size") > OVERFULL * target)
        over = [r["unit"] for r in sums.collect() if r["unit"] < light]
        if not over:
            break
        crowded = placed.where(F.col("unit").isin(over))
        # At most total / target keys can be this heavy.
        found = crowded.groupBy("key").agg(F.sum("size").alias("size")).where(F.col("size") > target).collect()
        heavy = dict(zip(split.heavy.tolist(), split.pieces.tolist(), strict=True))
        heavy |= {r["key"]: 1 if r["size"] <= total / shards else int(np.ceil(r["size"] / target)) for r in found}
        keys = np.array(sorted(heavy), np.int64)
        rest = crowded.where(~F.col("key").isin([r["key"] for r in found])) if found else crowded
        more = _sampled_bounds(rest, step, 4 * len(over) + 1)
        new = Splitters(np.unique(np.r_[split.bounds, more]), keys, np.array([heavy[k] for k in keys.tolist()], np.int64))
        if len(new.bounds) == len(split.bounds) and len(new.heavy) == len(split.heavy):
            break
        split = new
    return split


def shard_by_splitters(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (id, size long, key long, further columns) with ``shard`` and ``slot``.

    The driver holds one number per part of at most ``PART_ROWS`` rows.
    Sizes must be positive.  ``slot`` counts from 0 within a shard without
    gaps, by key and id.  Null ids and repeated rows are placed like any other;
    an empty table gives an empty one.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    ship_package(rows.sparkSession)
    rows = materialize(rows.withColumn("tie", F.pmod(F.xxhash64(F.lit("tie"), "id"), F.lit(1 << 62))), "shard-rows")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    split = find_splitters(rows, total, shards)

    # A unit of many small rows is numbered in parts, so that no task numbers more.
    part_rows = max(1, min(PART_ROWS, -(-2 * count // (shards * RANGES_PER_SHARD))))
    placed = rows.withColumn("unit", _unit_column(split))
    sums = placed.groupBy("unit").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    shard_of, parts = np.zeros(split.units, np.int32), np.ones(split.units, np.int64)
    load = [(0, s) for s in range(shards)]
    for r in sorted(sums, key=lambda r: (-r["size"], r["unit"])):
        least, s = heapq.heappop(load)
        heapq.heappush(load, (least + r["size"], s))
        shard_of[r["unit"]], parts[r["unit"]] = s, -(-r["n"] // part_rows)
    first = np.r_[0, np.cumsum(parts)[:-1]]

    @F.pandas_udf("int")
    def part(unit: pd.Series, tie: pd.Series) -> pd.Series:
        u = unit.to_numpy(np.int64)
        return pd.Series((first[u] + (tie.to_numpy(np.int64) >> 20) % parts[u]).astype(np.int32))

    placed = placed.withColumn("part", part("unit", "tie"))
    counts = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    shard_of_part = np.repeat(shard_of, parts)
    offset, filled = np.zeros(len(shard_of_part), np.int64), [0] * shards
    for p, s in enumerate(shard_of_part.tolist()):
        offset[p] = filled[s]
        filled[s] += counts.get(p, 0)

    @F.pandas_udf("shard int, base long")
    def place(p: pd.Series) -> pd.DataFrame:
        at = p.to_numpy(np.int64)
        return pd.DataFrame({"shard": shard_of_part[at], "base": offset[at]})

    number = F.row_number().over(Window.partitionBy("part").orderBy("key", "id"))
    return (placed.withColumn("number", number).withColumn("place", place("part"))
            .withColumn("shard", F.col("place.shard")).withColumn("slot", F.col("place.base") + F.col("number") - 1)
            .drop("tie", "unit", "part", "number", "place"))


def document_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                    carry: Sequence[str] = ()) -> DataFrame:
    """(id, size, text_crc32, key, shard, slot[, row]) of documents; equal texts have equal keys.

    The size is the text's UTF-8 bytes plus 1; a null text counts as no bytes.
    ``carry`` names columns of ``docs`` to take along in the struct ``row``.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key"),
                       *([F.struct(*carry).alias("row")] if carry else []))
    return shard_by_splitters(rows, shards).withColumnRenamed("id", id_col)


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Write the carried rows below ``path``/shard=N/, with their slot and in its
    order within a file.  A carried column named shard or slot gives way."""
    carried = [F.col(f"row.`{c}`") for c in placed.schema["row"].dataType.names if c not in ("shard", "slot")]
    block = F.floor(F.col("slot") / rows_per_file).alias("__block")
    (placed.select(*carried, "shard", "slot", block).repartition("shard", "__block")
     .sortWithinPartitions("shard", "__block", "slot").drop("__block").write.partitionBy("shard").parquet(path))
