import hashlib
import random
import zlib
from collections import Counter, defaultdict

from cases import rows_of
from pyspark.sql import types as T

from tidemark.llm import catalog, prefix_trie

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
    *[T.StructField(n, T.StringType()) for n in ("conv", "part", "digest", "size", "k1", "depth", "kind", "tie", "i", "weight")]])
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"x" * (len(SCHEMA) - 4)) for r in rows], SCHEMA)


def twin(rows):
    """The nodes, from whole sequences held as tuples."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256((str(len(role.encode())) + ":" + role + text).encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    plain = {c: [t for *_, t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for conv, own in plain.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = abs(conv) // 100 * 100 * (1 if conv >= 0 else -1)
        built[conv] = tuple(plain.get(base, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for conv, seq in built.items():
        ends[seq].append(conv)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(conv)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(who) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(((min(who), len(n), min(members[n[:-1]]) if n else None, len(who), children[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, who in members.items()), key=repr)


def check(spark, rows):
    assert rows_of(prefix_trie.prefix_trie(frame(spark, rows)), *COLUMNS) == twin(rows)


def test_awkward(spark):
    long = "word " * 50_000
    check(spark, [
        (0, 1, "user", "a"), (0, 2, None, None), (0, None, "user", "first"), (0, 3, "user", "b"), (0, 3, "user", "b"),
        (1, 0, "user", long), (2, 0, "user", long), (3, 5, "x", "漢字🙂"), (3, 4, "", ""), (7, None, None, None),
        (101, 0, "user", "no base"), (102, 0, "user", "no base"), (102, 1, "user", "tie b"), (102, 1, "user", "tie a"),
        (None, 0, "user", "no conversation"), (-5, 0, "user", "negative"), (-105, 1, "user", "negative"), (-100, 1, "u", "base"),
        (200, 0, "a:", "b"), (201, 0, "a", ":b"), *[(c, t, "u", f"turn {t}") for c in (301, 302, 303) for t in range(9)]])


def test_empty(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).count() == 0
    check(spark, [(None, 1, "user", "x")] * 2 + [(4, 1, "user", "one turn")])


def test_long_conversations_cross_parts(spark):
    rng = random.Random(5)
    rows = [(c, t, "u", rng.choice("ab") if t > 20 else "same") for c in (100, 101, 105, 230) for t in range(400)]
    rows += [(c, t, "u", "same") for c in range(300, 420) for t in range(rng.randint(1, 9))]
    rng.shuffle(rows)
    check(spark, rows)


def test_random_families(spark):
    rng = random.Random(8)
    for _ in range(2):
        rows = [(c, t if rng.random() < .95 else None, rng.choice(["user", "assistant", None]), rng.choice(["x", "yy", "", None]))
                for c in rng.sample(range(400), 60) for t in range(rng.randint(1, 7))]
        check(spark, rows)


def test_end_lists_are_joined_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "END_CHUNK", 7)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 1 / 10)
    check(spark, [(c, t, "u", "copy") for c in range(95, 260) for t in range(8)] + [(c, 0, "u", str(c)) for c in range(900, 960)])


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(catalog.op11_collapse(spark, sf_small), *COLUMNS) == twin(rows)
