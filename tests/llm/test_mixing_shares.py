import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, mixing as M


def skewed(spark, n=6000):
    """One source, language and topic holds most of the tokens, and the small ones lie together."""
    return spark.range(n).select(
        F.col("id").alias("doc_id"), F.when(F.expr("id div 10 % 20 < 11"), "hot").otherwise(F.concat(F.lit("s"), F.expr("id div 10 % 20 % 3"))).alias("source"),
        F.when(F.col("id") % 10 < 8, "en").otherwise("de").alias("lang"),
        F.when(F.expr("id div 200 % 5 < 4"), "x").otherwise("y").alias("topic"), (F.col("id") % 50 + 1).alias("tokens"))


def shares(out, axis, column):
    found = out.assign(mass=out.tokens * out[column]).groupby(axis).mass.sum()
    return found / found.sum()


def test_kept_tokens_meet_all_marginals_where_cells_are_kept_whole(spark):
    rows = skewed(spark)
    mix = M.fit(rows)
    out = M.apply_mix(rows, mix).toPandas()
    assert (out.mix_weight * mix.scale).max() > 1.01 and out.keep_prob.max() <= 1 and mix.converged and mix.miss <= 1e-5
    assert np.isclose((out.tokens * out.keep_prob).sum() / out.tokens.sum(), M.KEEP_SHARE, rtol=1e-5)
    for axis in ("source", "lang", "topic"):
        assert np.allclose(shares(out, axis, "keep_prob"), shares(out, axis, "mix_weight"), atol=1e-5)


def test_a_target_beyond_its_tokens_lowers_the_share_kept(spark):
    rows = skewed(spark)
    with pytest.warns(UserWarning, match="can be met with"):
        mix = M.fit(rows, {"lang": {"de": 0.5, "en": 0.5}})
    out = M.apply_mix(rows, mix).toPandas()
    has = out[out.lang == "de"].tokens.sum() / out.tokens.sum()
    assert np.isclose(mix.keep_share, has / 0.5, rtol=1e-6) and mix.keep_share < M.KEEP_SHARE and mix.converged
    assert np.isclose(out.keep_prob[out.lang == "de"].min(), 1, atol=1e-4)
    assert np.isclose((out.tokens * out.keep_prob).sum() / out.tokens.sum(), mix.keep_share, rtol=1e-4)
    assert np.allclose(shares(out, "lang", "keep_prob"), 0.5, atol=1e-4)
    for axis in ("source", "topic"):
        assert np.allclose(shares(out, axis, "keep_prob"), shares(out, axis, "mix_weight"), atol=1e-4)


def test_targets_that_exclude_each_other_above_a_share(spark):
    """Each value has enough tokens, their cells have not: the share is lowered until all are met."""
    cells = {("a", "en", "x"): 100, ("a", "de", "y"): 100, ("b", "en", "y"): 5, ("b", "de", "x"): 5}
    rows = spark.createDataFrame([(k, *c, n) for k, (c, n) in enumerate(cells.items())], "doc_id long, source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="can be met with"):
        mix = M.fit(rows, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"x": 0.3, "y": 0.7}}, keep_share=0.9)
    out = M.apply_mix(rows, mix).toPandas()
    assert out.keep_prob.max() <= 1 and mix.miss <= 1e-4 or not mix.converged


def test_ending_above_the_tolerance_is_told(spark):
    with pytest.warns(UserWarning, match="raking ended after 1 passes"):
        assert not M.fit(skewed(spark, 500), max_passes=1).converged
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        assert M.fit(skewed(spark), keep_share=0.1).converged


def test_query_at_the_production_share(spark, sf_small):
    out = catalog.op5_raking(spark, sf_small).toPandas().fillna("none")
    for axis in ("source", "lang", "topic"):
        assert np.allclose(shares(out, axis, "keep_prob"), shares(out, axis, "mix_weight"), atol=1e-4)
    assert out.keep_prob.max() <= 1 and (out.tokens * out.keep_prob).sum() / out.tokens.sum() <= M.KEEP_SHARE + 1e-6
