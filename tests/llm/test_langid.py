import math
import random
import zlib

import numpy as np
import pytest
from cases import AWKWARD, docs

from tidemark.llm import catalog, ecoc_langid as L


def test_query_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = catalog.op7_ecoc(spark, sf_dir).collect()
    assert len(out) == len(lang)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred in {"de", "en", "es", "fr"} or (r.lang_pred == "und" and not L.has_letter(lang[r.doc_id][1]))
    test = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id][0] for r in test) / len(test) > 0.98


def test_held_out_rows_teach_nothing(spark):
    rows = [(k, "aaa bbb aab" if k % 2 else "xyz zzy yyx", "l1" if k % 2 else "l2", None) for k in range(40)]
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 4 == 2]
    rows += [(k + 1000, "qqq", "only held out", None) for k in range(100) if zlib.crc32(str(k + 1000).encode()) % 4 == 2]
    table = docs(spark, rows)
    model = L.train(table.where(~L.held_out()))
    assert model.languages == ["l1", "l2"] and held
    out = {r.doc_id: r.lang_pred for r in L.identify(table, model).collect()}
    assert all(out[k] == ("l1" if k % 2 else "l2") for k in range(40))


def test_awkward(spark):
    table = docs(spark, AWKWARD)
    out = L.identify(table, L.train(table))
    got = {(r.doc_id, r.lang_pred, r.ambiguous) for r in out.collect()}
    assert {i for i, x, _ in got if x == "und"} == {1, 2, 3, 9, None}
    assert out.count() == len(AWKWARD)
    nothing = L.train(docs(spark, []))
    assert {r.lang_pred for r in L.identify(table, nothing).collect()} == {"und"}
    one = L.train(docs(spark, [(1, "words", "en", None)]))
    assert {r.lang_pred for r in L.identify(table, one).collect()} == {"und", "en"}
    assert L.identify(docs(spark, []), one).count() == 0
    kept = L.keep_identified(table, one)
    assert kept.columns == table.columns and kept.count() == len(AWKWARD) - 5


def test_codewords():
    for n in range(2, 30):
        code = L.codewords(n)
        gap = min(int((a != b).sum()) for k, a in enumerate(code) for b in code[:k])
        assert gap >= (code.shape[1] / 4 if n > 2 else 1) and (np.abs(code.sum(axis=0)) < n).all()


def test_a_flipped_bit_is_corrected_and_a_tie_is_flagged():
    code = L.codewords(4)
    model = L.Model(list("abcd"), code, np.zeros((1, 7)), np.full(code.shape, 1 / 7))
    for k in range(4):
        for flip in range(7):
            margins = code[k] * 3.0
            margins[flip] *= -1
            model.margins = lambda _, m=margins: m
            assert model.decode(None)[0] == "abcd"[k]
    model.margins = lambda _: np.zeros(7)
    assert model.decode(None)[2] and math.isclose(model.decode(None)[1], 0.25)


def test_parts_of_a_long_text_add_up(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abc é  .1Ж") for _ in range(2000))
    whole = L.ngram_counts(text)
    monkeypatch.setattr(L, "PART", 7)
    assert (L.ngram_counts(text) == whole).all()


def plain_ngrams(text):
    """1-, 2- and 3-grams in a dictionary: small letters, any run of other characters as one space, one before the text."""
    letters, out = " ", {}
    for c in text.lower():
        letters += c if c.isalpha() else "" if letters[-1] == " " else " "
    for n in (1, 2, 3):
        for k in range(len(letters) - n + 1):
            if n > 1 or letters[k] != " ":
                out[letters[k:k + n]] = out.get(letters[k:k + n], 0) + 1
    return out


def test_query_against_plain_codes(spark, sf_small):
    """The same code matrix, classifiers and weights from plain dictionaries of n-grams that are not hashed."""
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text", "lang").collect()
    learn = [r for r in rows if r.lang and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    languages = sorted({r.lang for r in learn})
    totals = {x: {} for x in languages}
    for r in learn:
        for gram, n in plain_ngrams(r.text).items():
            totals[r.lang][gram] = totals[r.lang].get(gram, 0) + n
    code = L.codewords(len(languages))
    sums = {x: sum(t.values()) + L.SMOOTHING * L.BUCKETS for x, t in totals.items()}
    weights = {}
    for gram in set().union(*totals.values()):
        share = np.array([(totals[x].get(gram, 0) + L.SMOOTHING) / sums[x] for x in languages])
        weights[gram] = [math.log(share[bit > 0].mean() / share[bit < 0].mean()) for bit in code.T]

    def margins(text):
        grams = plain_ngrams(text)
        total = sum(grams.values())
        return sum((n * np.array(weights[g]) for g, n in grams.items() if g in weights), np.zeros(code.shape[1])) * min(total, L.ENOUGH) / max(total, 1)

    right = {x: np.mean([margins(r.text) * code[k] > 0 for r in learn if r.lang == x], axis=0) for k, x in enumerate(languages)}
    trust = np.array([np.maximum(right[x], 0.01) / np.maximum(right[x], 0.01).sum() for x in languages])
    same = told = 0
    found = {r.doc_id: r for r in catalog.op7_ecoc(spark, sf_small).collect()}
    for r in rows:
        if not L.has_letter(r.text):
            assert found[r.doc_id].lang_pred == "und"
            continue
        loss = (trust * np.logaddexp(0, -code * margins(r.text))).sum(axis=1)
        told += 1
        same += languages[int(np.argmin(loss))] == found[r.doc_id].lang_pred
    assert same / told > 0.99


def test_labels_that_are_no_languages(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError):
        L.train(docs(spark, [(k, "words", f"l{k}", None) for k in range(4)]))
