import random

import xxhash
from cases import AWKWARD, docs

from tidemark.llm import catalog, simhash


def brute_fingerprint(text):
    words, word = [], ""
    for c in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "") + " ":
        if c in " \t\n\v\f\r":
            words, word = ([*words, word] if word else words), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(points, close):
    label = list(range(len(points)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k
    for a in range(len(points)):
        for b in range(a):
            if close(points[a], points[b]):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return [root(k) for k in range(len(points))]


def expect(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, _), g in zip(rows, groups, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, f"{fp:016x}", least.get(g)) for (i, _), fp, g in zip(rows, fps, groups, strict=True)), key=repr)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_query(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert got(catalog.op9_simhash(spark, sf_small)) == expect(rows)


def test_awkward_and_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 300)}" for _ in range(400)]
    rows = [(r[0], r[1]) for r in AWKWARD]
    for k in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(400)] = f"z{k}"
        rows.append((1000 - k, " ".join(words)))
    want = expect(rows)
    assert len({w[2] for w in want}) < 60
    table = docs(spark, [(i, t, "en", "a") for i, t in rows])
    # Small chunks: buckets are cut and their parts meet pair by pair.
    assert got(simhash.near_duplicates(table, chunk_rows=7)) == want
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_links_need_not_share_more_than_the_blocks(spark):
    rng = random.Random(9)
    fps = {0, (1 << 64) - 1}
    for _ in range(60):
        f = rng.getrandbits(64)
        fps |= {f, f ^ 1 << rng.randrange(64), f ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), f ^ 0b10101 << rng.randrange(59)}
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    out = simhash.linked_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"))
    groups = {}
    for r in out.collect():
        groups.setdefault(r.component, set()).add(r.node % (1 << 64))
    fps = sorted(fps)
    brute = {}
    for f, g in zip(fps, brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 2), strict=True):
        brute.setdefault(g, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in brute.values() if len(g) > 1)
