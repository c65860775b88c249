import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import cap_filters as C, catalog

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       *[T.StructField(n, T.StringType()) for n in ("id", "vector", "bucket", "component", "links", "kept", "copies")]])


def brute(rows):
    def usable(v):
        return bool(v) and all(a is not None for a in v) and np.isfinite(v).all() and any(v)
    near = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if usable(x) and usable(y) and len(x) == len(y):
                x, y = np.array(x, float) / max(map(abs, x)), np.array(y, float) / max(map(abs, y))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                    near[a].add(b)
                    near[b].add(a)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(near[k]), least, i == least))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, *("x",) * 7) for i, v in rows], SCHEMA)


def test_against_brute_force(spark):
    rng, dims = np.random.default_rng(5), 24
    vectors = [rng.standard_normal(dims) for _ in range(100)]
    for _ in range(12):
        x = rng.standard_normal(dims)
        x /= np.linalg.norm(x)
        for _ in range(6):
            y = rng.standard_normal(dims)
            y -= (y @ x) * x
            y /= np.linalg.norm(y)
            c = rng.uniform(0.88, 0.99)
            vectors.append((c * x + np.sqrt(1 - c * c) * y) * rng.uniform(0.1, 50))
    base = rng.standard_normal(dims)
    vectors += [vectors[0]] * 30 + [base + rng.standard_normal(dims) * 0.02 for _ in range(60)]
    rows = [(1000 - k, v.tolist()) for k, v in enumerate(vectors)]
    rows += [(2000 + k, v) for k, v in enumerate([None, [], [0.0] * dims, [float("nan")] * dims, [None] + [1.0] * (dims - 1),
                                                   [float("inf")] * dims, [1.0, 2.0], [1.0, 2.1], [3.0], [1e-300], [-0.0, 1e300], [0.0, 5e-324]])]
    rows += [(None, vectors[1].tolist()), (None, rng.standard_normal(dims).tolist()), (7, vectors[0].tolist()), (7, vectors[0].tolist())]
    assert got(C.near_duplicate_vectors(frame(spark, rows), chunk_rows=20)) == brute(rows)


def test_query_and_empty(spark, sf_small):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").limit(10_000).collect()]
    out = got(catalog.op8_caps(spark, sf_small))
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    assert {i: n for i, n, _, _ in out} == {i: int(n) for (i, _), n in zip(rows, (units @ units.T >= 0.9).sum(axis=1) - 1)}
    assert C.near_duplicate_vectors(frame(spark, [])).count() == 0


@pytest.mark.parametrize("vectors", [500, 50_000, 10_000_000])
def test_recall_at_the_border(vectors):
    assert C.expected_recall(64, vectors, 0.9, pairs=150) >= 0.97


def test_list_decoding_is_complete():
    rng = np.random.default_rng(1)
    for dims, n in ((12, 300), (7, 50), (2, 10), (1, 3)):
        for code in C.product_codes(dims, n):
            for _ in range(5):
                v = rng.standard_normal(dims)
                v /= np.linalg.norm(v)
                turned, sums = code.rotation @ v, np.zeros(1)
                for w, a, b in zip(code.words, code.cuts[:-1], code.cuts[1:]):
                    sums = (sums[:, None] + (w @ turned[a:b])[None, :]).ravel()
                want = set(np.flatnonzero(sums >= code.height).tolist()) | {int(np.argmax(sums))}
                assert set(code.decode(v)) == want


def test_many_vectors_decode_as_one_by_one():
    rng = np.random.default_rng(2)
    for dims, n in ((64, 50_000), (12, 300), (1, 3)):
        units = rng.standard_normal((20, dims))
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        codes = C.product_codes(dims, n)
        for row, got_row in zip(units, C.directions(codes, units), strict=True):
            want = np.unique(np.concatenate([C._numbered(dims, c.number, np.array(c.decode(row), np.uint64)) for c in codes]))
            assert got_row.tolist() == want.tolist()


def test_sketches_keep_pairs_at_the_border():
    rng, most = np.random.default_rng(3), C.sketch_distance(0.9)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal(x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
    x_signs, y_signs = (C.sign_sketches(v).view(np.uint64) for v in (x, y))
    far = np.bitwise_count(x_signs ^ y_signs).sum(axis=1)
    assert far.max() <= most < C.SKETCH_BITS // 2
    assert (np.bitwise_count(x_signs[1:] ^ x_signs[:-1]).sum(axis=1) > most).mean() > 0.98
