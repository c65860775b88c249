import math
import re

from cases import docs

from tidemark.llm import secrets as S

KEYS = ("59owoo3sb09glshv616mts56zc4pz0lx", "ieqh524yng5by1a2rogubbb8ayn1b7o2", "Zx81Qm0aLr7TvB2nK9sYwE4d")
PLAIN = ("a-slug-with-3-words-2020-and-1999-more", "2024-01-31-release-notes-for-v2", "/usr/local/share/python3/site-packages",
         "123e4567-e89b-12d3-a456-426614174000", "id=123E4567-E89B-12D3-A456-426614174000/backup-of-2024",
         "parseHTMLDocumentFromStream2", "20240131T120000Z-nightly-build", "abcdefghijklmnopqrstuvwxyz0123456789")
BEFORE = ("auth=", "key-", "sess_", "2024-01-31-", "sample-", "example/", "00000000-", "123e4567-e89b-12d3-a456-426614174000-")


def spans_of(spark, texts):
    found = S.scan_secrets(docs(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).select("doc_id", "spans").collect()
    return [[(s["start"], s["end"]) for s in r.spans if s["kind"] == 3] for r in sorted(found, key=lambda r: r.doc_id)]


def entropy(w):
    return -sum(w.count(x) / len(w) * math.log2(w.count(x) / len(w)) for x in set(w))


def test_keys_behind_allowed_parts_are_found(spark):
    texts = [f"see {b}{k}" for b in BEFORE for k in KEYS] + [f"see {'words-and-more/' * 300}{k}" for k in KEYS]
    for text, spans in zip(texts, spans_of(spark, texts), strict=True):
        key = text[-min(len(k) for k in KEYS if text.endswith(k)):]
        start = len(text) - len(key)
        least = 3.5 if key.islower() else 3.7
        for i in range(start, len(text) - S.WINDOW + 1):
            if entropy(text[i:i + S.WINDOW]) >= least:
                assert any(a <= i and b >= i + S.WINDOW for a, b in spans), (text[-80:], i)
        assert spans and all(b > start for _, b in spans)


def test_words_dates_and_uuids_add_nothing(spark):
    assert spans_of(spark, PLAIN) == [[]] * len(PLAIN)
    long = ["some/path-of_words=" * 2000, "Word" * 5000, "a1-" * 5000]
    assert spans_of(spark, long) == [[]] * 3 and all(re.fullmatch(S.ALLOWED[0], x) for x in long)


def test_keys_with_few_digits_are_found(spark):
    keys = ["kQzXvRbTnWpLsHdGfJmC", "kQzXvRbTnW4pLsHdGfJmC", "kQzXvRb7TnWpLsHdGf2JmC/YqBx", "QZXVRBTNWPLSHDGFJMCK", "qzxvrbtnwplshdgfjmck"]
    words = ["internationalization", "getElementsByTagNameAndClass", "AbstractSingletonProxyFactoryBean", "some-long-slug-without-any-digits"]
    found = spans_of(spark, keys + words)
    assert found == [[(0, len(k))] for k in keys] + [[]] * len(words)
