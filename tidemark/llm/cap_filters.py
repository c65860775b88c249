"""Embedding near-duplicates by spherical-cap filters.

Filter directions are the words of random product codes: after a random
rotation a vector is cut into blocks, every block has its own list of random
unit vectors, and a direction is one choice per block.  A vector is decoded to
the list of all directions whose inner product with it exceeds the cap's
height; close vectors exceed common directions.  Rows join on directions and
every pair that meets is checked by its cosine in double precision.

What travels to a direction is a row's id and a short sign sketch.  Rows of
which no sketch comes near end there; the others form candidate sets, alike ones
found under many directions become one, and only their members' vectors are fetched,
once a set.

The height follows the number of vectors, so that a cap holds a few unrelated
vectors at any size; several independent codes keep the chance to miss a pair
small (``expected_recall``).
"""

from __future__ import annotations

from dataclasses import dataclass
from math import acos, comb, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.buckets import Arrays, check_buckets, local_roots
from tidemark.llm.common import map_rows, materialize
from tidemark.llm.components import connected_components

MIN_COSINE = 0.9
# Codes for up to BASE_VECTORS vectors; their number grows as a small power of
# the vectors, since higher caps are shared by a smaller part of the close pairs.
CODES = 8
BASE_VECTORS = 50_000
CODES_POWER = 0.12
# Directions of one code that a vector is expected to exceed.
LIST_LENGTH = 4.0
# Unrelated vectors expected in a cap.
CAP_ROWS = 2.0
MAX_BLOCK_WORDS = 8192
CHUNK_ROWS = 1000
# Scores that list decoding compares at once.
DECODE_CELLS = 1 << 20
# Signs of a vector on random hyperplanes travel with its directions; pairs that meet are looked at
# further unless their signs differ in more places than a pair at the least cosine does with this chance.
SKETCH_BITS = 128
SKETCH_MISS = 1e-9
SEED = 23


def cap_share(height: float, dims: int) -> float:
    """Share of the unit sphere with an inner product of at least ``height`` with a given direction."""
    x = np.linspace(-1.0, 1.0, 20_001)
    density = np.power(np.maximum(1.0 - x * x, 0.0), (dims - 3) / 2) if dims > 3 else np.ones_like(x)
    return float(density[x >= height].sum() / density.sum())


def cap_height(share: float, dims: int) -> float:
    low, high = -1.0, 1.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if cap_share(mid, dims) > share else (low, mid)
    return low


@dataclass
class ProductCode:
    rotation: np.ndarray
    words: list[np.ndarray]   # per block: words x dims, of length 1 / sqrt(blocks)
    cuts: np.ndarray
    height: float
    number: int

    def decode(self, vector: np.ndarray) -> list[int]:
        """Directions with an inner product of at least the height, and always the best one."""
        return self.decode_many(vector[None, :])[1].tolist()

    def decode_many(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for a matrix of vectors: row of the vector and direction, sorted and without repeats."""
        turned = units @ self.rotation.T
        scores = [turned[:, a:b] @ w.T for w, a, b in zip(self.words, self.cuts[:-1], self.cuts[1:], strict=True)]
        tops = [s.max(axis=1) for s in scores]
        owner, sums, ids = np.arange(len(units)), np.zeros(len(units)), np.zeros(len(units), np.int64)
        rest, best = np.sum(tops, axis=0), np.zeros(len(units), np.int64)
        for s, top in zip(scores, tops, strict=True):
            rest = rest - top
            best = best * s.shape[1] + s.argmax(axis=1)
            # Only beginnings that the best words of the other blocks can still lift over the height.
            need = self.height - rest[owner] - sums
            step, parts = max(1, DECODE_CELLS // s.shape[1]), []
            for k in range(0, len(owner), step):
                rows, cols = np.nonzero(s[owner[k:k + step]] >= need[k:k + step, None])
                parts.append((rows + k, cols))
            rows, cols = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
            ids, sums, owner = ids[rows] * s.shape[1] + cols, sums[rows] + s[owner[rows], cols], owner[rows]
        owner, ids = np.r_[owner, np.arange(len(units))], np.r_[ids, best]
        order = np.lexsort((ids, owner))
        owner, ids = owner[order], ids[order]
        new = np.r_[True, (owner[1:] != owner[:-1]) | (ids[1:] != ids[:-1])] if len(owner) else np.zeros(0, bool)
        return owner[new], ids[new]


def product_codes(dims: int, vectors: int, codes: int | None = None, list_length: float = LIST_LENGTH,
                  cap_rows: float = CAP_ROWS, seed: int = SEED) -> list[ProductCode]:
    """Codes for ``vectors`` vectors of ``dims`` dimensions."""
    codes = codes or int(np.ceil(CODES * max(1.0, vectors / BASE_VECTORS) ** CODES_POWER))
    share = min(0.25, cap_rows / max(vectors, 1))
    directions = max(2.0, list_length / share)
    blocks = 1
    while directions ** (1 / blocks) > MAX_BLOCK_WORDS and blocks < dims or blocks < min(2, dims):
        blocks += 1
    size = max(2, round(directions ** (1 / blocks)))
    cuts = np.linspace(0, dims, blocks + 1).astype(int)
    height = cap_height(share, dims)
    found = []
    for number in range(codes):
        rng = np.random.default_rng([seed, number, dims])
        rotation = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
        words = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            w = rng.standard_normal((size, b - a))
            words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(blocks))
        found.append(ProductCode(rotation, words, cuts, height, number))
    return found


def expected_recall(dims: int, vectors: int, cosine: float = MIN_COSINE, pairs: int = 300, seed: int = 1, **options) -> float:
    """Share of random pairs at exactly ``cosine`` that meet in some cap."""
    rng, codes, met = np.random.default_rng(seed), product_codes(dims, vectors, **options), 0
    for _ in range(pairs):
        x = rng.standard_normal(dims)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(dims)
        y -= (y @ x) * x
        y = cosine * x + np.sqrt(1 - cosine ** 2) * y / np.linalg.norm(y)
        met += any(set(c.decode(x)) & set(c.decode(y)) for c in codes)
    return met / pairs


def pack(values: list | None) -> bytes | None:
    """The vector as bytes, in floats where that loses nothing; None if it cannot link with anything."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    v = np.array(values, np.float64) + 0.0
    if not np.isfinite(v).all() or not v.any():
        return None
    with np.errstate(over="ignore", under="ignore"):
        small = v.astype(np.float32)
    return b"f" + small.tobytes() if (small == v).all() else b"d" + v.tobytes()


def unit_vector(packed: bytes) -> np.ndarray:
    """The vector at length 1, in doubles."""
    v = np.frombuffer(packed, np.float32 if packed[:1] == b"f" else np.float64, offset=1).astype(np.float64)
    v = v / np.abs(v).max()
    return v / np.sqrt((v * v).sum())


def dimensions(packed: bytes) -> int:
    return (len(packed) - 1) // (4 if packed[:1] == b"f" else 8)


def sign_sketches(units: np.ndarray) -> np.ndarray:
    """``SKETCH_BITS`` signs of each row on random hyperplanes, as two longs."""
    planes = np.random.default_rng([SEED, SKETCH_BITS, units.shape[1]]).standard_normal((SKETCH_BITS, units.shape[1]))
    return np.packbits(units @ planes.T >= 0, axis=1).view(np.int64)


def sketch_distance(min_cosine: float) -> int:
    """The number of signs in which a pair at ``min_cosine`` differs at most, but for ``SKETCH_MISS``."""
    p = acos(max(-1.0, min(1.0, min_cosine))) / pi
    tail, bits = 0.0, SKETCH_BITS
    while bits > 0 and tail + (chance := comb(SKETCH_BITS, bits) * p ** bits * (1 - p) ** (SKETCH_BITS - bits)) <= SKETCH_MISS:
        tail, bits = tail + chance, bits - 1
    return bits


def _candidates(max_bits: int):
    """For all buckets of a batch at once: the candidate set of every row, 0 for none.

    A set is named by its member of the least hash, so that the much alike sets
    that close vectors leave under their directions are mostly one; it holds no
    vector that was not found together with that member.  What a chunked bucket
    finds is named by the bucket.
    """
    def prepare(frame: pd.DataFrame) -> Arrays:
        key, own = frame[["bucket", "a", "b"]].to_numpy(), frame["own"].to_numpy()
        high, low = (frame[c].to_numpy().view(np.uint64) for c in ("high", "low"))  # of signed numbers NumPy counts the bits of the absolute value
        ids = frame["id"].to_numpy()
        ends = np.flatnonzero(np.r_[(key[1:] != key[:-1]).any(axis=1), True]) + 1
        end = np.repeat(ends, np.diff(np.r_[0, ends]))
        crossed = key[:, 1] != key[:, 2]
        at, left, right, step = np.arange(len(frame)), [], [], 0
        while len(at):
            step += 1
            at = at[at + step < end[at]]
            to = at + step
            near = np.bitwise_count(high[at] ^ high[to]) + np.bitwise_count(low[at] ^ low[to]) <= max_bits
            near &= ~crossed[at] | (own[at] != own[to])
            left.append(at[near])
            right.append(to[near])
        root = local_roots(len(frame), np.concatenate(left), np.concatenate(right))
        names, members = np.full(len(frame), ~np.uint64(0)), np.bincount(root, minlength=len(frame))
        np.minimum.at(names, root, _spread(ids.astype(np.uint64)))
        group = np.where(key[:, 2] > 0, key[:, 0], names[root].view(np.int64))
        return {"id": ids, "group": np.where(members[root] > 1, np.where(group == 0, 1, group), 0)}

    return prepare


def _found(group: Arrays, left: np.ndarray, right: np.ndarray) -> Arrays | None:
    found = group["group"] != 0
    return {c: v[found] for c, v in group.items()} if found.any() else None


def _arrays(frame: pd.DataFrame) -> Arrays:
    """Columns for the pair check; the vectors as one matrix where they are alike."""
    packed = frame["vector"].tolist()
    if len({(p[:1], len(p)) for p in packed}) == 1:
        kind = np.float32 if packed[0][:1] == b"f" else np.float64
        units = np.frombuffer(b"".join([p[1:] for p in packed]), kind).reshape(len(packed), -1).astype(np.float64)
        units /= np.abs(units).max(axis=1, keepdims=True)
        units /= np.sqrt((units * units).sum(axis=1, keepdims=True))
    else:
        units = np.empty(len(packed), object)
        units[:] = [unit_vector(p) for p in packed]
    return {"unit": units, "dims": np.array([len(u) for u in units])} | {c: frame[c].to_numpy() for c in ("id", "copies", "bucket", "buckets")}


def _pair_checker(min_cosine: float):
    def check(group: Arrays, left: np.ndarray, right: np.ndarray) -> Arrays | None:
        ids, weights = group["id"], group["copies"]
        units, dims = group["unit"], group["dims"]
        if units.ndim == 1:  # other lengths in the same batch, hardly ever in the same bucket
            units = np.stack([np.pad(u, (0, dims.max() - len(u))) for u in units])
        i, j = np.nonzero((units[left] @ units[right].T >= min_cosine - 1e-12) & (dims[left][:, None] == dims[right][None, :]))
        if left is right and len(i) == len(left):
            return None  # every vector meets only itself
        i, j = left[i], right[j]
        i, j = (i[i < j], j[i < j]) if left is right else (i, j)
        # Decide the border by the same sum in one fixed order, whatever the block.
        exact = np.einsum("ij,ij->i", units[i], units[j]) if len(i) <= 1 << 16 else np.concatenate(
            [np.einsum("ij,ij->i", units[i[k:k + (1 << 16)]], units[j[k:k + (1 << 16)]]) for k in range(0, len(i), 1 << 16)])
        i, j = i[exact >= min_cosine], j[exact >= min_cosine]
        if not len(i):
            return None
        # A pair counts in the first candidate set it shares: rows of ``before`` are
        # the sets below this one that a vector also belongs to.
        bucket = group["bucket"][0]
        lists = [np.asarray(f, np.int64) for f in group["buckets"]]
        known, at = np.unique(np.concatenate([f[f < bucket] for f in lists]), return_inverse=True)
        before = np.zeros((len(ids), len(known)), np.float32)
        before[np.repeat(np.arange(len(ids)), [int((f < bucket).sum()) for f in lists]), at] = 1.0
        used = np.unique(np.r_[i, j])
        slot = np.full(len(ids), -1)
        slot[used] = np.arange(len(used))
        first = (before[used] @ before[used].T)[slot[i], slot[j]] == 0
        i, j = i[first], j[first]
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, i, weights[j])
        np.add.at(links, j, weights[i])
        root = local_roots(len(ids), i, j)
        found = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return {"id": ids[found], "links": links[found], "root": ids[root[found]]} if len(found) else None

    return check


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           min_cosine: float = MIN_COSINE, chunk_rows: int = CHUNK_ROWS, **options) -> DataFrame:
    """(id, n_links, component_id, kept): one row per input row.

    Vectors link at a cosine of ``min_cosine`` or more; vectors of different
    lengths do not.  Null, empty and zero vectors and those with a null or
    non-finite component link with nothing.  Equal vectors are
    one point with a number of copies, so a group of copies of
    any size costs one row.  Rows with a null id link like others and are never
    named as a component unless all are null; an empty table gives an empty one.
    """

    def make():
        def step(ids, values):
            packed = [pack(v) for v in values]
            return [ids, packed, [None if p is None else dimensions(p) for p in packed]]
        return step

    kind = vectors.schema[id_col].dataType.simpleString()
    rows = materialize(map_rows(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")), ["id", "v"],
                                f"id {kind}, vector binary, dims int", make), "packed-vectors")
    points = rows.where("vector IS NOT NULL").groupBy("vector", "dims").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    points = materialize(points.withColumn("id", F.monotonically_increasing_id()), "points")
    sizes = {r["dims"]: r["n"] for r in points.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()}

    def make_lists():
        codes = {dims: product_codes(dims, n, **options) for dims, n in sizes.items()}

        def step(ids, vectors):
            found, sketches = [None] * len(ids), np.zeros((len(ids), 2), np.int64)
            for dims in {dimensions(v) for v in vectors}:
                rows = [k for k, v in enumerate(vectors) if dimensions(v) == dims]
                units = np.stack([unit_vector(vectors[k]) for k in rows])
                sketches[rows] = sign_sketches(units)
                for k, buckets in zip(rows, directions(codes[dims], units), strict=True):
                    found[k] = buckets
            return [ids, sketches[:, 0], sketches[:, 1], found]
        return step

    lists = materialize(map_rows(points, ["id", "vector"], "id long, high long, low long, buckets array<long>", make_lists), "cap-lists")
    met = check_buckets(lists.select("id", "high", "low", F.explode("buckets").alias("bucket")), "id", "id long, group long",
                        _found, chunk_rows, _candidates(sketch_distance(min_cosine)))
    # A vector is in no more sets than directions (and chunked buckets), so its list is short.
    sets = materialize(met.distinct().groupBy("id").agg(F.collect_list("group").alias("buckets")), "candidate-sets")
    members = materialize(sets.join(points.select("id", "vector", "copies"), "id"), "candidates")
    met = materialize(check_buckets(members.withColumn("bucket", F.explode("buckets")), "id", "id long, links long, root long",
                                    _pair_checker(min_cosine), chunk_rows, _arrays), "cap-links")
    linked = connected_components(met.where("id <> root").select(F.col("id").alias("src"), F.col("root").alias("dst")))
    links = met.groupBy("id").agg(F.sum("links").alias("links"))
    named = points.join(linked.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left") \
        .withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_point = materialize(named.join(least, "component").select(
        "vector", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "point-components")
    found = rows.join(of_point, "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                        F.col("id").eqNullSafe(component).alias("kept"))


def directions(codes: list[ProductCode], units: np.ndarray) -> list[np.ndarray]:
    """For each unit vector, the sorted bucket numbers of all directions that it exceeds."""
    found = [c.decode_many(units) for c in codes]
    owner = np.concatenate([o for o, _ in found])
    buckets = np.concatenate([_numbered(units.shape[1], c.number, ids.astype(np.uint64)) for c, (_, ids) in zip(codes, found, strict=True)])
    order = np.argsort(owner, kind="stable")
    return [np.unique(b) for b in np.split(buckets[order], np.cumsum(np.bincount(owner, minlength=len(units)))[:-1])]


def _numbered(dims: int, code: int, words: np.ndarray) -> np.ndarray:
    """Spread (dims, code, word) over the longs; two that meet there only make a larger bucket."""
    with np.errstate(over="ignore"):
        return _spread(words * np.uint64(0x9E3779B97F4A7C15) + np.uint64(dims * 1_000_003 + code * 7919 + 1)).view(np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
