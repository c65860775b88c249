"""SimHash near-duplicates found with pigeonhole blocks.

The 64 bits of a fingerprint are cut into blocks.  Two fingerprints that differ
in at most d bits differ in at most d blocks, so with ``d + 2`` blocks they
agree on at least two whole blocks; every pair of blocks is one join key, and
rows that meet on a key are checked by Hamming distance.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.buckets import CHUNK_ROWS, Arrays, check_buckets, local_roots
from tidemark.llm.common import map_rows, materialize
from tidemark.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Hashes of a long text are added up in parts of this many shingles.
PART = 50_000


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, as an unsigned integer.

    A-Z become lower case; words are runs without white space (space and
    U+0009 to U+000D).  A text of fewer words than a shingle is one shingle; a
    null text or one without words has the fingerprint zero.
    """
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return digest(b" ".join(parts), SEED)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    count = len(parts) - words + 1
    ones = np.zeros(64, np.int64)
    for low in range(0, count, PART):
        high = min(count, low + PART)
        spans = zip(starts[low:high].tolist(), ends[low + words - 1:high + words - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, high - low)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, one row per input row."""

    def make():
        def step(ids, texts):
            values = np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)
            return [ids, values.tolist()]
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(source, ["id", "text"], f"id {kind}, fp long", make)


def block_keys(fp, max_bits: int = MAX_BITS) -> list:
    """One key per pair of blocks: (pair number, the two blocks' bits)."""
    blocks = max_bits + 2
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    parts = [F.shiftrightunsigned(fp, 64 - cuts[k + 1]).bitwiseAND(F.lit((1 << (cuts[k + 1] - cuts[k])) - 1))
             for k in range(blocks)]
    return [F.xxhash64(F.lit(n), parts[a], parts[b]) for n, (a, b) in enumerate(combinations(range(blocks), 2))]


def close_pairs(max_bits: int) -> Callable:
    """Checks one bucket; returns each member's link to the smallest position it reaches."""

    def check(group: Arrays, left: np.ndarray, right: np.ndarray) -> Arrays | None:
        fps = group["fp"]
        bits = fps.view(np.uint64)
        i, j = np.nonzero(np.bitwise_count(bits[left][:, None] ^ bits[right][None, :]) <= max_bits)
        root = local_roots(len(fps), left[i], right[j])
        moved = np.flatnonzero(root != np.arange(len(fps)))
        return {"src": fps[moved], "dst": fps[root[moved]]} if len(moved) else None

    return check


def linked_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(node, component) of distinct fingerprints linked at ``max_bits`` or fewer differing bits."""
    keyed = fps.select("fp", F.explode(F.array(*block_keys(F.col("fp"), max_bits))).alias("bucket"))
    edges = check_buckets(keyed, "fp", "src long, dst long", close_pairs(max_bits), chunk_rows)
    return connected_components(edges)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(id, fingerprint, component_id): one row per input row.

    Equal fingerprints are first reduced to one row each, so a group of copies
    of any size is a single point.  ``component_id`` is the smallest id that can
    be reached over links.  Null texts and texts without words share the
    fingerprint zero and are linked like any other; a null id is never chosen
    as component while another id is there; repeated rows each stay; an empty
    table gives an empty one.  Other columns are ignored.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    linked = linked_fingerprints(classes.select("fp"), max_bits, chunk_rows)
    named = classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left") \
                   .withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = materialize(named.join(least, "component").select("fp", "component_id"), "fingerprint-components")
    return rows.join(of_class, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
