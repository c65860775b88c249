"""Check pairs inside buckets without writing the pairs.

Rows carry a bucket; a NumPy function sees the rows of one bucket (or of two
chunks of it) and returns a few rows per input row.  A bucket of more than
``chunk_rows`` rows is cut into chunks by a hash of the row's id, and each pair
of chunks becomes its own group, so no task holds more than two chunks of a
bucket and a hot bucket spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, ship_package

CHUNK_ROWS = 2000


Arrays = dict[str, np.ndarray]


def check_buckets(rows: DataFrame, id_col: str, schema: str,
                  check: Callable[[Arrays, np.ndarray, np.ndarray], Arrays | None],
                  chunk_rows: int = CHUNK_ROWS,
                  prepare: Callable[[pd.DataFrame], Arrays] | None = None) -> DataFrame:
    """``rows`` has a long column ``bucket``; ``check(group, left, right)`` gets
    the columns of a group's rows and the positions of its two sides (the same
    array when the group is one chunk) and returns columns of ``schema`` or None.
    ``prepare`` turns many rows at once into the arrays that are then cut into
    groups (by default the columns as they are).
    """
    ship_package(rows.sparkSession)
    big = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
                      .where(F.col("n") > chunk_rows)
                      .select("bucket", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks")), "big-buckets")
    placed = rows.join(big, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.when(F.col("chunks") > 1, F.pmod(F.xxhash64(F.lit("chunk"), F.col(id_col)), F.col("chunks")).cast("int")).otherwise(F.lit(0))
    dealt = (placed.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))
             .drop("chunks", "other"))
    key = ["bucket", "a", "b"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in _with_end(frames):
            last = frame is None
            if last:
                frame = rest
            elif rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            if frame is None or not len(frame):
                continue
            ids = frame[key].to_numpy()
            starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(axis=1)])
            ends = np.r_[starts[1:], len(frame)]
            if not last:
                rest, starts, ends = frame.iloc[starts[-1]:].reset_index(drop=True), starts[:-1], ends[:-1]
            found, several = [], ends - starts > 1
            if not several.any():
                continue
            arrays = prepare(frame) if prepare else {c: frame[c].to_numpy() for c in frame.columns}
            side = frame["own"].to_numpy()
            for s, e in zip(starts[several].tolist(), ends[several].tolist(), strict=True):
                a, b = ids[s, 1], ids[s, 2]
                left = np.arange(e - s) if a == b else np.flatnonzero(side[s:e] == a)
                right = left if a == b else np.flatnonzero(side[s:e] == b)
                out = check({c: v[s:e] for c, v in arrays.items()}, left, right)
                if out is not None:
                    found.append(out)
            if found:
                yield pd.DataFrame({c: np.concatenate([f[c] for f in found]) for c in found[0]})

    return dealt.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, schema)


def _with_end(frames):
    yield from frames
    yield None


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n points, the smallest point reachable over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
