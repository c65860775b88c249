"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a linear classifier over hashed
character n-grams says on which side a text lies.  The language is the codeword
with the smallest loss, each bit weighted by how well its classifier did on
that language, and a text whose best codeword hardly leads is flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_rows, map_stream, materialize, ship_package, text_or_empty

BUCKETS = 1 << 14
# The classifiers learn from about this many documents of each language.
SAMPLE_PER_LANGUAGE = 1000
SMOOTHING = 0.5
# n-grams beyond so many add no more certainty.
ENOUGH = 150
AMBIGUOUS_BELOW = 0.6
UNDETERMINED = "und"
# The driver holds a row of counts per language; more labels than this are refused.
MAX_LANGUAGES = 1000
SEED = 11
PART = 1 << 20

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of 1-, 2- and 3-grams of the whole text: small letters, any
    run of other characters as one space."""
    letter, counts = _is_letter(), np.zeros(BUCKETS, np.int64)
    tail = np.full(1, 32, np.uint32)
    for low in range(0, len(text), PART):
        codes = np.frombuffer(text[low:low + PART].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(letter[codes], codes, np.uint32(32))
        codes = np.r_[tail, codes]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        # The last two of the part before have been counted already.
        seen, codes = int(keep[:len(tail)].sum()), codes[keep]
        a = codes * np.uint32(2654435761)
        one = a[seen:][codes[seen:] != 32]
        two = (a[:-1] * np.uint32(31) ^ codes[1:] * np.uint32(40503))[max(0, seen - 1):] * np.uint32(2246822519)
        three = (a[:-2] * np.uint32(131) ^ codes[1:-1] * np.uint32(3266489917) ^ codes[2:] * np.uint32(668265263))[max(0, seen - 2):]
        for hashes in (one, two, three * np.uint32(374761393)):
            counts += np.bincount(hashes >> np.uint32(18), minlength=BUCKETS)
        tail = codes[-2:]
    return counts


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def codewords(languages: int, seed: int = SEED) -> np.ndarray:
    """Rows of -1/+1 with distant rows: all splits of the languages for a few,
    the best of many random codes for more."""
    if languages <= 1:
        return np.ones((languages, 1), np.int8)
    if languages <= 6:
        splits = np.arange(1, 1 << (languages - 1))
        return np.where(splits[None, :] >> np.arange(languages)[:, None] & 1, 1, -1).astype(np.int8)
    bits = max(31, int(np.ceil(10 * np.log2(languages))))
    rng, best, lead = np.random.default_rng(seed), None, -1
    for _ in range(100):
        code = rng.choice(np.array([-1, 1], np.int8), (languages, bits))
        agree = code.astype(np.int32) @ code.T.astype(np.int32)
        np.fill_diagonal(agree, -bits)
        distance = int((bits - agree.max()) // 2)
        if distance > lead and (np.abs(code.sum(axis=0)) < languages).all():
            best, lead = code, distance
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray          # languages x bits
    weights: np.ndarray       # buckets x bits
    trust: np.ndarray         # languages x bits, rows sum to 1

    def margins(self, counts: np.ndarray, evidence: int | None = None) -> np.ndarray:
        """Margins of the classifiers, as of ``evidence`` n-grams like these (by
        default as many as there are, ``ENOUGH`` at most)."""
        total = counts.sum()
        return counts @ self.weights * ((evidence or min(total, ENOUGH)) / max(total, 1))

    def decode(self, counts: np.ndarray, evidence: int | None = None) -> tuple[str, float, bool]:
        """Language, its share among the codewords, and whether it is ambiguous."""
        margins = self.margins(counts, evidence) if evidence else self.margins(counts)
        loss = (self.trust * np.logaddexp(0.0, -self.code * margins)).sum(axis=1)
        share = np.exp(-self.code.shape[1] * (loss - loss.min()))
        share /= share.sum()
        best = int(np.argmax(share))
        return self.languages[best], float(share[best]), bool(share[best] < AMBIGUOUS_BELOW)


def training_sample(docs: DataFrame, text_col: str, label_col: str, id_col: str, per_language: int) -> DataFrame:
    """(text, lang) of about ``per_language`` documents of each language, drawn by a hash of the id."""
    known = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col(label_col).alias("lang")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: the label column does not hold languages")
    if not sizes:
        return known.select(F.col(text_col).alias("text"), F.col(label_col).alias("lang")).limit(0)
    chance = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, per_language / n))])
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(id_col)), 11) / F.lit(float(1 << 53))
    return known.where(draw < chance[F.col(label_col)]).select(F.col(text_col).alias("text"), F.col(label_col).alias("lang"))


def train(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
          per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from labelled rows; rows with a null text or label are not used.

    The driver gets one count per language and bucket, and one share per
    language and bit.
    """
    sample = materialize(training_sample(docs, text_col, label_col, id_col, per_language), "language-sample")

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[str, np.ndarray] = {}
        for text, lang in rows:
            counts = ngram_counts(text)
            sums[lang] = sums[lang] + counts if lang in sums else counts
        for lang, counts in sums.items():
            for bucket in np.flatnonzero(counts).tolist():
                yield lang, bucket, int(counts[bucket])

    table = map_stream(sample, ["text", "lang"], "lang string, bucket int, n long", count) \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    if not languages:
        return Model([], codewords(0), np.zeros((BUCKETS, 1)), np.zeros((0, 1)))
    counts = np.zeros((len(languages), BUCKETS))
    counts[table["lang"].map({x: k for k, x in enumerate(languages)}), table["bucket"]] = table["n"]
    shares = counts + SMOOTHING
    shares /= shares.sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    if len(languages) == 1:
        return Model(languages, code, np.zeros((BUCKETS, 1)), np.ones((1, 1)))
    yes = (code > 0).astype(float)
    weights = np.log(yes.T @ shares / yes.sum(axis=0)[:, None]) - np.log((1 - yes).T @ shares / (1 - yes).sum(axis=0)[:, None])
    model = Model(languages, code, weights.T.copy(), np.zeros(code.shape))

    def right(rows: Iterator[tuple]) -> Iterator[tuple]:
        hits, seen = np.zeros(code.shape, np.int64), np.zeros(len(languages), np.int64)
        for text, lang in rows:
            k = languages.index(lang)
            hits[k] += model.margins(ngram_counts(text)) * code[k] > 0
            seen[k] += 1
        for k in np.flatnonzero(seen).tolist():
            for bit in range(code.shape[1]):
                yield k, bit, int(hits[k, bit]), int(seen[k])

    got = map_stream(sample, ["text", "lang"], "k int, bit int, hits long, seen long", right) \
        .groupBy("k", "bit").agg((F.sum("hits") / F.sum("seen")).alias("share")).toPandas()
    trust = np.full(code.shape, 0.5)
    trust[got["k"], got["bit"]] = got["share"]
    model.trust = np.maximum(trust, 0.01) / np.maximum(trust, 0.01).sum(axis=1, keepdims=True)
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous): one row per input row.

    ``und`` with score 0 for a null text, one without letters, or a model that
    has learned nothing; repeated rows each stay; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value

        def step(ids, texts):
            found = [model.decode(ngram_counts(t)) if model.languages and has_letter(t) else (UNDETERMINED, 0.0, False) for t in texts]
            return [ids, *map(list, zip(*found, strict=True))] if ids else [[], [], [], []]
        return step

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return map_rows(source, ["id", "text"], f"id {kind}, lang_pred string, score double, ambiguous boolean", make) \
        .withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", evidence: int = ENOUGH) -> DataFrame:
    """The rows of ``docs`` whose language can be told, with their own columns.

    Rejected are texts that are null or have no letter, and those that are
    ambiguous.  A text is judged by how its n-grams are mixed, not by their number:
    texts of all lengths are decoded as if they had ``evidence`` n-grams.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def told(texts: pd.Series) -> pd.Series:
        model = shared.value

        def one(text: str) -> bool:
            return bool(model.languages) and has_letter(text) and not model.decode(ngram_counts(text), evidence)[2]
        return texts.map(one)

    return docs.where(told(text_or_empty(text_col)))
