"""Mixing sources to target weights by iterative proportional fitting.

Token weights are raked until the shares of sources, languages and topics meet
their targets; a document is then drawn with a probability in proportion to the
weight of its cell.  Where that would exceed 1, such cells are kept whole and the
rest is raked again, so that the drawn tokens meet the targets.  The share of all
tokens that is drawn is the largest, up to a wanted one, at which they can: no
value is asked for more tokens than it has.  Cells are summed before anything is gathered.  Languages
and topics are few, sources may be many: the fit keeps one factor per language
and topic on the driver, and a pass over the table of sources gives every
source's factor from those.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

# A marginal's target share of a value is its token share to this power, so
# large values shrink; targets can also be given outright.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
# At most this share of the tokens is kept; less where the targets ask for it.
KEEP_SHARE = 0.6
# A share at which the targets cannot be met together is lowered by this factor.
LOWER = 0.95
MISS = 1e-4
TOLERANCE = 1e-6
MAX_PASSES = 100
# The driver holds a factor for each pair of a language and a topic; more than these are refused.
MAX_PAIRS = 10_000
SEED = 5
NONE = "\0none"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from how a text is written (the first that fits)."""
    words = word_count(text)
    return (F.when(words == 0, "empty")
            .when(text.rlike(r"(?i)\b(?:licen[cs]e|copyright|warranty)\b"), "legal")
            .when(text.rlike(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.|\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b"), "contact")
            .when(text.contains("?"), "questions")
            .when(words < 100, "short")
            .when(words < 1000, "article")
            .otherwise("long"))


@dataclass
class Mix:
    """A fitted mix: weights per token are source factor x pair factor."""

    factors: DataFrame                       # source key, factor, keep_factor
    pairs: dict[tuple[str, str], float]      # (lang key, topic key) -> factor
    passes: int
    error: float                             # largest miss of a language or topic share
    scale: float                             # probability = scale x weight where that nowhere exceeds 1
    keep_pairs: dict[tuple[str, str], float]  # probability = min(1, keep_factor x this)
    miss: float                              # largest miss of a share among the tokens expected to be kept
    converged: bool                          # all shares are met
    keep_share: float                        # share of the tokens expected to be kept


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NONE))


def _shares(totals: dict[str, float], temper: float, given: dict[str, float] | None) -> dict[str, float]:
    raw = {k: (given.get(k, 0.0) if given else v ** temper) for k, v in totals.items() if v > 0}
    total = sum(raw.values())
    if total <= 0:
        raise ValueError("no value with a positive target has tokens")
    return {k: v / total for k, v in raw.items()}


def fit(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, temper: dict[str, float] = TEMPER,
        keep_share: float = KEEP_SHARE, tolerance: float = TOLERANCE, max_passes: int = MAX_PASSES) -> Mix | None:
    """Rake ``docs`` (source, lang, topic, tokens long); None if there are no tokens.

    ``targets`` may give shares for ``lang`` and ``topic``, and for ``source``
    (values it does not name get none); the rest is tempered.
    """
    spark, targets = docs.sparkSession, targets or {}
    cells = materialize(docs.where("tokens > 0").groupBy(_key("source").alias("source"), _key("lang").alias("lang"), _key("topic").alias("topic"))
                        .agg(F.sum("tokens").cast("double").alias("n")), "mix-cells")
    pairs = [(r["lang"], r["topic"], r["n"]) for r in
             cells.groupBy("lang", "topic").agg(F.sum("n").alias("n")).orderBy("lang", "topic").limit(MAX_PAIRS + 1).collect()]
    if len(pairs) > MAX_PAIRS:
        raise ValueError(f"more than {MAX_PAIRS} pairs of a language and a topic: fold the rare values first")
    if not pairs:
        return None
    langs, topics = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs})
    at = {(a, b): k for k, (a, b, _) in enumerate(pairs)}
    row = np.array([langs.index(a) for a, _, _ in pairs])
    col = np.array([topics.index(b) for _, b, _ in pairs])
    mass = np.array([n for _, _, n in pairs])
    want_lang = _shares({x: mass[row == k].sum() for k, x in enumerate(langs)}, temper["lang"], targets.get("lang"))
    want_topic = _shares({x: mass[col == k].sum() for k, x in enumerate(topics)}, temper["topic"], targets.get("topic"))
    want_row = np.array([want_lang.get(x, 0.0) for x in langs])
    want_col = np.array([want_topic.get(x, 0.0) for x in topics])

    place = F.create_map(*[F.lit(x) for (a, b), k in at.items() for x in (f"{a}\1{b}", k)])
    cells = cells.withColumn("at", place[F.concat_ws("\1", "lang", "topic")])
    if targets.get("source"):
        given = F.create_map(*[F.lit(x) for k, v in targets["source"].items() for x in (k, float(v))])
        want = F.coalesce(given[F.col("source")], F.lit(0.0))
    else:
        want = F.pow("total", F.lit(temper["source"]))
    sources = cells.groupBy("source").agg(F.sum("n").alias("total"), F.collect_list(F.struct("at", "n")).alias("cells")).withColumn("want", want)
    sources = materialize(sources, "mix-sources")
    whole = sources.agg(F.sum("want")).first()[0]
    if not whole:
        raise ValueError("no source with a positive target has tokens")

    def with_factor(factors: np.ndarray) -> DataFrame:
        each = "array(" + ",".join(f"{x!r}D" for x in factors.tolist()) + ")"
        return sources.withColumn("factor", F.expr(
            f"want / {whole!r}D / aggregate(cells, 0D, (s, c) -> s + c.n * {each}[c.at])"))

    b, c = np.ones(len(langs)), np.ones(len(topics))
    error, passes = np.inf, 0
    while True:
        got = with_factor(b[row] * c[col]).select("factor", F.explode("cells").alias("x")) \
            .groupBy("x.at").agg(F.sum(F.col("factor") * F.col("x.n")).alias("n")).collect()
        base = np.zeros(len(pairs))
        for r in got:
            base[r["at"]] = r["n"] or 0.0
        now = base * b[row] * c[col]
        error = max(np.abs(np.bincount(row, now, len(langs)) - want_row).max(), np.abs(np.bincount(col, now, len(topics)) - want_col).max())
        passes += 1
        if error <= tolerance or passes >= max_passes:
            break
        sums = np.bincount(row, base * c[col], len(langs))
        b = np.divide(want_row, sums, out=np.zeros_like(b), where=sums > 0)
        sums = np.bincount(col, base * b[row], len(topics))
        c = np.divide(want_col, sums, out=np.zeros_like(c), where=sums > 0)

    converged = bool(error <= tolerance)
    if not converged:
        warnings.warn(f"raking ended after {passes} passes with a share {error:.2g} off its target", stacklevel=2)
    pair = b[row] * c[col]
    factors = materialize(with_factor(pair).select("source", F.coalesce("factor", F.lit(0.0)).alias("factor"), "want", "cells"), "mix-factors")
    weight = F.expr("x.n"), F.col("factor") * F.expr(f"{_array(pair)}[x.at]")
    each = factors.select(F.explode("cells").alias("x"), "factor").select(weight[0].alias("n"), weight[1].alias("w"))
    total, top = float(mass.sum()), each.agg(F.max("w")).first()[0]
    live = each.where("w > 0")
    # At this share every probability is scale x weight, so it can always be kept.
    least = min(keep_share, float(live.agg(F.sum(F.col("n") * F.col("w"))).first()[0]) / top / total)
    share = min(keep_share, _reach(factors, pair, ((row, want_row), (col, want_col))) / total)
    keep, miss, met = pair, float(error), True
    while True:
        share = max(share, least)
        scale = share * total / float(live.agg(F.sum(F.col("n") * F.col("w"))).first()[0])
        if top * scale <= 1.0 + 1e-12:
            kept = factors.withColumn("keep_factor", F.col("factor") * F.lit(scale))
            keep, miss, met = pair, float(error), True
            break
        axes = (row, want_row), (col, want_col)
        kept, keep, miss, met = _keep_whole(factors, pair, scale, axes, share * total, tolerance, max_passes)
        # Targets that contradict each other are missed whatever the share, so they do not lower it further.
        if miss <= max(MISS, 2 * float(error)):
            met = True
            break
        share *= LOWER
    factors = kept
    converged = converged and met
    if share < keep_share:
        warnings.warn(f"the targets can be met with {share:.3g} of the tokens, not with {keep_share:.3g}", stacklevel=2)
    named = [(langs[r], topics[k]) for r, k in zip(row, col, strict=True)]
    return Mix(factors.select("source", "factor", "keep_factor"), dict(zip(named, pair.tolist(), strict=True)),
               passes, float(error), scale, dict(zip(named, keep.tolist(), strict=True)), miss, converged, share)


def _array(values: np.ndarray) -> str:
    return "array(" + ",".join(f"{x!r}D" for x in values.tolist()) + ")"


def _reach(factors: DataFrame, pair: np.ndarray, axes: tuple) -> float:
    """The most tokens that can be kept before some source, language or topic is
    asked for more than it has."""
    live = factors.where("factor > 0").select("source", "want", F.explode(
        F.expr(f"filter(cells, c -> {_array(pair)}[c.at] > 0)")).alias("x"))
    sources = live.groupBy("source").agg(F.sum("x.n").alias("most"), F.max("want").alias("want"))
    whole = factors.agg(F.sum("want")).first()[0]
    found = [sources.where("want > 0").agg(F.min(F.col("most") / F.col("want")) * F.lit(whole)).first()[0]]
    most = np.zeros(len(pair))
    for r in live.groupBy("x.at").agg(F.sum("x.n").alias("n")).collect():
        most[r["at"]] = r["n"]
    for at, want in axes:
        has = np.bincount(at, most, len(want))
        found.append(float((has[want > 0] / want[want > 0]).min()))
    return min(found)


def _keep_whole(factors: DataFrame, pair: np.ndarray, scale: float, axes: tuple, goal: float, tolerance: float,
                max_passes: int) -> tuple[DataFrame, np.ndarray, float, bool]:
    """Rakes the probabilities min(1, keep_factor x pair factor) until the expected tokens, sum ``goal``, meet the targets.

    Returns the factors with keep_factor, the pair factors, the largest miss of a
    target share and whether it converged.
    """
    live = F.expr(f"filter(cells, c -> {_array(pair)}[c.at] > 0)")
    sources = factors.withColumn("live", F.when(F.col("factor") > 0, live).otherwise(F.expr("filter(cells, c -> false)")))
    sources = sources.withColumn("most", F.expr("aggregate(live, 0D, (s, c) -> s + c.n)"))
    sources = materialize(sources, "mix-live")
    aims = [want * goal for _, want in axes]
    total = sources.agg(F.sum("want")).first()[0]
    sources = sources.withColumn("aim", F.least("most", F.col("want") * F.lit(goal / total)))

    def with_keep(g: np.ndarray) -> DataFrame:
        # The sum of n x min(1, f x g) is the least of the lines that take the largest g as kept whole, so f is the largest solution.
        step = ("named_struct('n', s.n + c.n, 'g', s.g + c.n * c.g, 'f', greatest(s.f, (aim - most + s.n + c.n) / (s.g + c.n * c.g)))")
        ordered = f"array_sort(transform(live, c -> named_struct('g', {_array(g)}[c.at], 'n', c.n)))"
        return sources.withColumn("keep_factor", F.expr(
            f"CASE WHEN size(live) = 0 THEN 0D WHEN aim >= most * (1 - 1e-12D) THEN 1 / array_min(transform(live, c -> {_array(g)}[c.at])) "
            f"ELSE aggregate({ordered}, named_struct('n', 0D, 'g', 0D, 'f', 0D), (s, c) -> {step}, s -> s.f) END"))

    factor = [np.ones(len(want)) for _, want in axes]
    passes, offs = 0, []
    while True:
        g = pair * scale * np.prod([f[at] for f, (at, _) in zip(factor, axes, strict=True)], axis=0)
        chance = F.col("keep_factor") * F.expr(f"{_array(g)}[x.at]")
        got = with_keep(g).select("keep_factor", F.explode("live").alias("x")).select("x.at", "x.n", chance.alias("p")).groupBy("at").agg(
            F.sum(F.when(F.col("p") >= 1, F.col("n")).otherwise(0.0)).alias("whole"),
            F.sum(F.when(F.col("p") < 1, F.col("n") * F.col("p")).otherwise(0.0)).alias("part")).collect()
        whole, part = np.zeros(len(pair)), np.zeros(len(pair))
        for r in got:
            whole[r["at"]], part[r["at"]] = r["whole"], r["part"]
        sums = [np.bincount(at, whole + part, len(want)) for at, want in axes]
        off = max(np.abs(now - aim).max() for now, aim in zip(sums, aims, strict=True)) / goal
        passes += 1
        offs.append(off)
        # Shares that cannot all be met together come no nearer after some passes.
        if off <= tolerance or passes >= max_passes or passes > 12 and min(offs[-10:]) > 0.999 * min(offs[:-10]):
            break
        for k, (at, want) in enumerate(axes):
            fixed, free = np.bincount(at, whole, len(want)), np.bincount(at, part, len(want))
            ask = aims[k] - fixed
            # With too much kept whole already, the value is lowered as a whole.
            change = np.where(ask > 0, np.divide(ask, free, out=np.ones(len(want)), where=free > 0),
                              np.divide(aims[k], fixed + free, out=np.ones(len(want)), where=fixed + free > 0))
            change = np.clip(change, 0.1, 10.0)
            factor[k] = factor[k] * change
            part = part * change[at]
    source_miss = sources.agg(F.max(F.abs(F.col("aim") / F.lit(goal) - F.col("want") / F.lit(total)))).first()[0]
    miss = max([np.abs(now / now.sum() - want).max() for now, (_, want) in zip(sums, axes, strict=True)] + [source_miss])
    return materialize(with_keep(g), "mix-keep"), g, float(miss), bool(off <= tolerance)


def apply_mix(docs: DataFrame, mix: Mix | None, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with mix_weight, keep_prob and kept.

    Columns of these names are replaced.  Rows without tokens weigh nothing and are not drawn.  A document's draw
    depends on its id alone, so repeated rows share their fate.  The source
    factors are a written table: broadcast only where Spark finds it small,
    otherwise joined by sorting, with a large source split.
    """
    if mix is None:
        return docs.withColumns({"mix_weight": F.lit(0.0), "keep_prob": F.lit(0.0), "kept": F.lit(False)})
    pair, keep = (F.create_map(*[F.lit(x) for (a, b), v in found.items() for x in (f"{a}\1{b}", v)]) for found in (mix.pairs, mix.keep_pairs))
    joined = docs.withColumn("__source", _key("source")).join(
        mix.factors.select(F.col("source").alias("__source"), F.col("factor").alias("__factor"), F.col("keep_factor").alias("__keep")),
        "__source", "left")
    at = F.concat_ws("\1", _key("lang"), _key("topic"))
    weight = F.when(F.col("tokens") > 0, F.col("__factor") * pair[at])
    chance = F.when(F.col("tokens") > 0, F.col("__keep") * keep[at])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id_col)), 11) / F.lit(float(1 << 53))
    return (joined.withColumn("mix_weight", F.coalesce(weight, F.lit(0.0)))
            .withColumn("keep_prob", F.least(F.lit(1.0), F.coalesce(chance, F.lit(0.0))))
            .withColumn("kept", draw < F.col("keep_prob")).drop("__source", "__factor", "__keep"))
