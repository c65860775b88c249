import numpy as np
from cases import AWKWARD, docs
from pyspark.sql import functions as F

from tidemark.llm import catalog, mixing as M


def brute(cells, temper, targets=None, rounds=2000):
    """Raking over the full table of cells: {(source, lang, topic): tokens} -> {cell: weight per token}."""
    weight = {c: 1.0 for c in cells}
    for _ in range(rounds):
        for axis, name in enumerate(("source", "lang", "topic")):
            values = {c[axis] for c in cells}
            totals = {v: sum(n for c, n in cells.items() if c[axis] == v) for v in values}
            want = {v: (targets or {}).get(name, {}).get(v, 0.0) if (targets or {}).get(name) else totals[v] ** temper[name] for v in values}
            for v in values:
                now = sum(n * weight[c] for c, n in cells.items() if c[axis] == v)
                for c in cells:
                    if c[axis] == v:
                        weight[c] *= want[v] / sum(want.values()) / now if now else 0.0
    return weight


def brute_keep(cells, weight, temper, most=M.KEEP_SHARE, rounds=200):
    """Probabilities min(1, product of factors) over the full table of cells, one value solved after the other,
    at the largest share of the tokens that asks no value for more than it has."""
    total, wants = sum(cells.values()), []
    for axis, name in enumerate(("source", "lang", "topic")):
        has = {v: sum(n for c, n in cells.items() if c[axis] == v) for v in {c[axis] for c in cells}}
        whole = sum(n ** temper[name] for n in has.values())
        wants.append({v: (n ** temper[name] / whole, n) for v, n in has.items()})
    goal = min([most * total] + [n / want for axis in wants for want, n in axis.values()])
    chance = {c: goal * weight[c] for c in cells}
    for _ in range(rounds if max(chance.values()) > 1 else 0):
        for axis in range(3):
            for v, (want, _) in wants[axis].items():
                mine = [c for c in cells if c[axis] == v]
                low, high = 0.0, max(1 / chance[c] for c in mine)
                for _ in range(60):
                    mid = (low + high) / 2
                    enough = sum(cells[c] * min(1.0, chance[c] * mid) for c in mine) >= want * goal
                    low, high = (low, mid) if enough else (mid, high)
                for c in mine:
                    chance[c] *= high
    return {c: min(1.0, p) for c, p in chance.items()}, goal / total


def cells_of(rows):
    cells = {}
    for r in rows:
        if r.tokens:
            key = (r.source, r.lang, r.topic)
            cells[key] = cells.get(key, 0) + r.tokens
    return cells


def test_query_against_brute_force(spark, sf_small):
    rows = catalog.op5_raking(spark, sf_small).collect()
    table = {r.doc_id: r for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert len(rows) == len(table) and all(r.tokens == len((table[r.doc_id].text or "").split()) for r in rows)
    want = brute(cells_of(rows), M.TEMPER, rounds=300)
    for r in rows:
        assert np.isclose(r.mix_weight, want[r.source, r.lang, r.topic] if r.tokens else 0.0, rtol=1e-3)
    chance, share = brute_keep(cells_of(rows), want, M.TEMPER)
    for r in rows:
        assert np.isclose(r.keep_prob, chance[r.source, r.lang, r.topic] if r.tokens else 0.0, atol=2e-3)
    total = sum(r.tokens for r in rows)
    assert np.isclose(sum(r.tokens * r.keep_prob for r in rows), share * total, rtol=1e-3)
    assert abs(sum(r.tokens for r in rows if r.kept) / total - share) < 0.15


def table(spark, n=4000):
    return spark.range(n).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 11)).alias("source"),
        F.when(F.col("id") % 5 < 3, "en").when(F.col("id") % 5 == 3, "de").alias("lang"),
        F.when(F.col("id") % 7 < 4, "x").otherwise("y").alias("topic"), (F.col("id") % 50).alias("tokens"))


def test_given_targets_are_met_and_draws_follow_them(spark):
    rows = table(spark)
    targets = {"lang": {"en": 0.5, "de": 0.3, M.NONE: 0.2}, "topic": {"x": 0.4, "y": 0.6}}
    mix = M.fit(rows, targets, keep_share=0.3)
    assert mix.error <= M.TOLERANCE and mix.passes < 30
    out = M.apply_mix(rows, mix).toPandas()
    out["mass"] = out.tokens * out.mix_weight
    assert np.isclose(out.mass.sum(), 1) and np.isclose(out[out.lang == "en"].mass.sum(), 0.5, atol=1e-5)
    assert np.isclose(out[out.lang.isna()].mass.sum(), 0.2, atol=1e-5) and np.isclose(out[out.topic == "x"].mass.sum(), 0.4, atol=1e-5)
    kept = out[out.kept]
    assert abs(kept[kept.topic == "x"].tokens.sum() / kept.tokens.sum() - 0.4) < 0.06
    assert abs(kept.tokens.sum() / out.tokens.sum() - 0.3) < 0.03
    again = M.apply_mix(rows.repartition(3), mix).where("kept").select("doc_id").toPandas()
    assert set(again.doc_id) == set(kept.doc_id)


def test_source_targets_and_caps(spark):
    rows = table(spark, 600)
    mix = M.fit(rows, {"source": {"hot": 0.9, "s1": 0.1}}, keep_share=0.9)
    out = M.apply_mix(rows, mix).toPandas()
    assert np.isclose((out.tokens * out.mix_weight)[out.source == "hot"].sum(), 0.9, atol=1e-5)
    assert out[~out.source.isin(["hot", "s1"])].keep_prob.max() == 0 and out.keep_prob.max() <= 1


def test_awkward(spark):
    rows = docs(spark, AWKWARD).select("doc_id", "source", "lang", M.topic_of(F.col("text")).alias("topic"),
                                      M.word_count(F.col("text")).alias("tokens"), "factor", "kept",
                                      F.lit("x").alias("keep_prob"), F.lit("x").alias("mix_weight"), F.lit("x").alias("at"), F.lit("x").alias("want"))
    mix = M.fit(rows)
    found = M.apply_mix(rows, mix)
    out = found.collect()
    assert sorted(found.columns) == sorted(rows.columns) and dict(found.dtypes)["kept"] == "boolean" and out[0].want == "x"
    assert len(out) == len(AWKWARD) and all((r.keep_prob > 0) == (r.tokens > 0) for r in out)
    none = rows.limit(0)
    assert M.fit(none) is None and M.apply_mix(none, None).count() == 0
