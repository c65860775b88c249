from cases import AWKWARD, docs
from pyspark.sql import functions as F

from tidemark.llm import stream_dedup as D
from tidemark.llm.common import materialize


def check(rows, out):
    assert sorted((r.doc_id for r in out), key=repr) == sorted((r[0] for r in rows), key=repr)
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    kept = {}
    for r in out:
        kept[r.digest, r.keep_id] = kept.get((r.digest, r.keep_id), 0) + r.kept
    want = sorted(((max((i for i in ids if i is not None), default=None), len(ids)) for ids in groups.values() for _ in ids), key=repr)
    assert sorted(((r.keep_id, r.group_size) for r in out), key=repr) == want
    assert sum(r.kept for r in out) == len(groups) and all(r.kept is False or r.doc_id == r.keep_id for r in out)


ROWS = [(*r,) for r in AWKWARD] + [(100 + k, f"text {k % 7}", "en", "a") for k in range(60)]


def test_awkward(spark):
    out = D.exact_dedup(docs(spark, ROWS)).collect()
    check(ROWS, out)
    assert D.exact_dedup(docs(spark, [])).count() == 0


def test_weak_digest_is_told_apart_by_the_bytes(spark):
    table = docs(spark, ROWS)
    weak = D.exact_dedup(table, digest=lambda t: F.unhex(F.hex(F.length(t) % 3)))
    assert weak.select("digest").distinct().count() == 3
    groups = {}
    for r in ROWS:
        groups.setdefault(r[1] or "", []).append(r[0])
    want = sorted(((max((i for i in ids if i is not None), default=None), len(ids)) for ids in groups.values() for _ in ids), key=repr)
    out = weak.collect()
    assert sorted(((r.keep_id, r.group_size) for r in out), key=repr) == want
    assert sum(r.kept for r in out) == len(groups)


def test_state_goes_on_where_it_stopped(spark, tmp_path):
    """Three runs over one growing log, with one state folder: the last sees every copy ever."""
    log = str(tmp_path / "log")
    state, updates = str(tmp_path / "state"), str(tmp_path / "updates")
    for part in range(3):
        rows = [(10 * part + k, f"t{k}" if k < 5 else f"t{part}-{k}") for k in range(8)]
        arrived = D.arrivals(materialize(spark.createDataFrame(rows, "doc_id long, text string"), "part"), "doc_id", "text")
        arrived.repartition(2).write.mode("append").parquet(log)
        # Tiny batches: every file is a batch of its own.
        found = D.run_state(spark.read.parquet(log), state, updates, bytes_per_batch=1).collect()
        assert sorted((r.keeper.id, r.n) for r in found) == sorted(
            [(10 * part + k, part + 1) for k in range(5)] + [(10 * p + k, 1) for p in range(part + 1) for k in range(5, 8)])
    assert len({p.name for p in (tmp_path / "updates").glob("batch_id=*")}) >= 6
    assert list((tmp_path / "state").rglob("*.zip")) or list((tmp_path / "state").rglob("*.changelog"))


def test_kept_rows_have_their_own_columns(spark):
    table = materialize(docs(spark, ROWS), "rows")
    kept = D.keep_first(table, D.exact_dedup(table, in_files=True))
    assert kept.columns == table.columns and kept.count() == len({r[1] or "" for r in ROWS})
    weak = D.keep_first(table, D.exact_dedup(table, digest=lambda t: F.unhex(F.hex(F.length(t) % 3)), in_files=True))
    assert sorted(r.text or "" for r in weak.collect()) == sorted({r[1] or "" for r in ROWS})


def test_locators_point_to_the_text(spark):
    table = materialize(docs(spark, ROWS).repartition(3), "rows")
    found = D.exact_dedup(table, in_files=True)
    keepers = found.select(F.col("keep_file").alias("file"), F.col("keep_row").alias("row"), "digest").distinct()
    fetched = D.fetch(table, keepers).select(F.coalesce("text", F.lit("")).alias("text"))
    assert sorted(r.text for r in fetched.collect()) == sorted({r[1] or "" for r in ROWS})
    assert fetched.count() == keepers.count()


def test_two_arrivals_at_a_state_equal_one(spark, tmp_path):
    for name, digest in (("sha", D.sha256_digest), ("weak", lambda t: F.unhex(F.hex(F.length(t) % 3)))):
        for part in (ROWS[::2], ROWS[1::2], []):
            found = D.exact_dedup(docs(spark, part), digest=digest, state_dir=str(tmp_path / name))
        want = D.exact_dedup(docs(spark, ROWS), digest=digest)
        key = ["doc_id", "keep_id", "group_size", "digest"]
        assert sorted(map(repr, found.select(key).collect())) == sorted(map(repr, want.select(key).collect()))
        assert found.where("kept").count() == len({r[1] or "" for r in ROWS})
