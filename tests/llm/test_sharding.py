import zlib

import pytest
from cases import AWKWARD, docs, rows_of
from pyspark.sql import functions as F

from tidemark.llm import catalog, sharding


def check(rows, shards):
    sizes = [0] * shards
    for s in range(shards):
        here = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in here) == list(range(len(here)))
        sizes[s] = sum(r.size for r in here)
    return sizes


def test_query_law(spark, sf_small):
    rows = catalog.op1_splitters(spark, sf_small).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        assert r.law == "bytes" and r.grown_shard is None
    sizes = check(rows, 16)
    assert max(sizes) - min(sizes) <= max(r.size for r in rows)
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(v) == 1 for v in where.values())


def test_hot_group_is_split_and_the_rest_is_whole(spark):
    # One key holds a third of the rows and nearly all bytes, another a third of the rows and few bytes.
    rows = spark.range(9000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 9).otherwise(F.xxhash64("id")).alias("key"),
        F.when(F.col("id") % 3 == 0, 1000).when(F.col("id") % 3 == 1, 1).otherwise(10).cast("long").alias("size"))
    out = sharding.shard_by_splitters(rows, 4).collect()
    sizes = check(out, 4)
    assert max(sizes) / (sum(sizes) / 4) < 1.02
    assert len({r.shard for r in out if r.key == 7}) == 4 and len({r.shard for r in out if r.key == 9}) == 1


def test_keys_with_a_gradient(spark):
    rows = spark.range(20000).select("id", F.col("id").alias("key"), (1 + F.col("id") % 97 * F.col("id") % 1013).alias("size"))
    sizes = check(sharding.shard_by_splitters(rows, 7).collect(), 7)
    assert max(sizes) / (sum(sizes) / 7) < 1.01


@pytest.mark.parametrize("rows", [AWKWARD, []])
def test_awkward(spark, rows):
    out = sharding.document_shards(docs(spark, rows), 3).collect()
    assert len(out) == len(rows)
    check(out, 3)
    assert sorted(r.size for r in out) == sorted(len((r[1] or "").encode()) + 1 for r in rows)


def test_written_shards(spark, tmp_path):
    placed = sharding.document_shards(docs(spark, AWKWARD), 2, carry=("doc_id", "text", "shard", "key"))
    sharding.write_shards(placed, str(tmp_path / "out"), rows_per_file=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows_of(back, "doc_id", "text", "shard", "slot") == rows_of(placed.select("row.text", "doc_id", "shard", "slot"),
                                                                      "doc_id", "text", "shard", "slot")
    assert back.count() == len(AWKWARD) and set(back.columns) == {"doc_id", "text", "key", "shard", "slot"}
