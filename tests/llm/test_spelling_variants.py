import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from cases import AWKWARD, docs, rows_of

from tidemark.llm import spelling_variants as V

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:k] + b[k + 1:] for k in range(len(b)))


def words_of(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = None if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            if h is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}


def twin(words):
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n, len(near[w]), form[w] and words[form[w]]) for w, n in words.items()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_acceptor_and_composition(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(250)})
    acceptor = V.Acceptor(words)
    rights = {}
    for state in range(len(acceptor.final)):  # minimal: no two states accept the same
        key = acceptor.final[state], tuple(acceptor.arcs[state].items())
        assert rights.setdefault(key, state) == state
    for position, word in enumerate(words):
        state, at = acceptor.start, 0
        for c in word:
            state, step = acceptor.arcs[state][c]
            at += step
        assert acceptor.final[state] and at == position
    got = sorted(tuple(sorted((words[i], words[j]))) for i, j in V.replaced(acceptor, acceptor))
    assert got == sorted((a, b) for a, b in combinations(words, 2) if len(a) == len(b) and one_edit(a, b))
    got = sorted((words[i], words[j]) for i, j in V.inserted(acceptor, acceptor))
    assert got == sorted((a, b) for a in words for b in words if len(b) == len(a) + 1 and one_edit(a, b))
    other = V.Acceptor(sorted({"".join(rng.choice("abc") for _ in range(4)) for _ in range(30)}))
    assert len(list(V.replaced(acceptor, other))) == len(list(V.replaced(other, acceptor)))


def word_rows(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.mark.parametrize("group_words", [V.GROUP_WORDS, 7])
def test_near_words(spark, group_words):
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(6, 9))): rng.randint(5, 400) for _ in range(300)}
    words |= {"aaaaaa": 50, "aaaaaaa": 50, "aaaaaaaa": 50, "aaaaaaaaa": 9, "a" * 3000: 5, "a" * 3001: 30, "b" + "a" * 3000: 30}
    got = rows_of(V.near_words(word_rows(spark, words), group_words=group_words), "word", "n_near", "best_n", "best")
    want = []
    for w in words:
        others = [o for o in words if abs(len(o) - len(w)) < 2 and o != w and one_edit(w, o)]
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            want.append((w, len(others), words[best], best))
    assert got == sorted(want, key=repr)


def test_roots(spark):
    chain = {f"word{k:02d}": f"word{k + 1:02d}" for k in range(21)} | {"x": "word03", "alone": "y"}
    got = dict(rows_of(V.roots_of(spark.createDataFrame(list(chain.items()), "word string, form string")), "word", "root"))
    assert got == {w: "y" if w == "alone" else "word21" for w in chain}


def test_whole_operator(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 10))) for _ in range(40)]
    rows = []
    for k in range(300):
        text = " ".join(rng.choice(base[:1 + rng.randint(0, 39)]).title() for _ in range(60))
        rows.append((k, text, "en", "a"))
    rows += [(k, (base[0][:-1] + "z ") * 3, "en", "a") for k in range(2)] + [(7, rows[7][1], "de", None)] * 3
    rows += [(None, "Naïveté× NAÏVETÉ÷ " * 4 + "naïveté× " * 3, None, None), *AWKWARD]
    assert rows_of(V.spelling_variants(docs(spark, rows)), *COLUMNS) == twin(words_of([r[:2] for r in rows]))
    assert V.spelling_variants(docs(spark, [])).count() == 0 and V.spelling_variants(docs(spark, AWKWARD[:3])).count() == 0
