import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from cases import AWKWARD, docs

from tidemark.llm import bpe, catalog


@pytest.fixture(scope="module")
def ranks():
    with open(P.path(catalog.VOCABULARY), "rb") as f:
        return bpe.load_ranks(f)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def digests(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_random_texts(ranks, library):
    codec, rng = bpe.Codec(ranks, P.PATTERN, max_pieces=500), random.Random(1)
    codec.transducer.max_moves = 3000  # full tables are emptied on the way
    letters = "abcdefghij éèñüß日本語🙂 \n\t  0123!!..''s<|endoftext|>ZK"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 50_000, "ab" * 9000, " " * 9000 + "x", "日" * 4000, "!" * 9000, "x" * 4096, "y" * 4097, "<|endoftext|>"]
    for text in texts:
        ids = codec.encode(text)
        assert ids == ",".join(map(str, library.encode_ordinary(text)))
        parts = list(codec.decode(ids))
        assert b"".join(b for b, _ in parts) == text.encode() and "".join(c for _, c in parts) == text


def test_window_cuts(ranks, library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 5)
    transducer, rng = bpe.Transducer(ranks), random.Random(2)
    for _ in range(2000):
        piece = "".join(rng.choice("aeioutnsrlé") for _ in range(rng.randint(1, 40))).encode()
        assert transducer.encode(piece) == library._encode_single_piece(piece)


def test_small_vocabulary_against_the_definition():
    rng = random.Random(3)
    for _ in range(20):
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 290:
            new = rng.choice(tokens[97:100] + tokens[256:]) + rng.choice(tokens[97:100] + tokens[256:])
            if new not in tokens:
                tokens.append(new)
        transducer = bpe.Transducer({t: k for k, t in enumerate(tokens)})
        for _ in range(200):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 20)))
            if piece not in transducer.ranks:
                assert transducer.encode(piece) == transducer._merge(piece)[0]
    with pytest.raises(ValueError):
        bpe.Transducer({b"a": 0})


def test_utf8_stream():
    data = "aé漢🙂".encode() * 3
    for step in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        out = [stream.feed(data[k:k + step]) for k in range(0, len(data), step)]
        assert "".join(out) + stream.finish() == data.decode() and stream.held == b""
    cut = bpe.Utf8Stream()
    assert cut.feed("🙂".encode()[:3]) == "" and cut.finish() == "�"
    assert bpe.Utf8Stream().feed(b"\x80\xffa") == "��a"


def test_query(spark, sf_small, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    out = catalog.op10_bpe(spark, sf_small).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == {i: digests(library, t) for i, t in texts.items()}


def test_awkward(spark, library):
    vocabulary = bpe.share_vocabulary(spark, P.path(catalog.VOCABULARY))
    out = bpe.encode_documents(docs(spark, AWKWARD), vocabulary, P.PATTERN, with_ids=True).collect()
    got = sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.token_ids)) for r in out)
    assert got == sorted((repr(r[0]), *digests(library, r[1]), library.encode_ordinary(r[1] or "")) for r in AWKWARD)
    assert bpe.encode_documents(docs(spark, []), vocabulary, P.PATTERN).count() == 0


def test_idle_workers_keep_no_tables_of_texts(spark):
    rows = [(k, f"zqx{k}vw ahgk{k * k}uel") for k in range(400)]
    found = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    vocabulary = bpe.share_vocabulary(spark, P.path(catalog.VOCABULARY))
    assert bpe.encode_documents(found, vocabulary, P.PATTERN).count() == len(rows)
    assert len(bpe.encode_documents(found, vocabulary, P.PATTERN).collect()) == len(rows)

    def held(batches):
        for _ in batches:
            time.sleep(0.05)
        sizes = [(len(c.pieces), len(c.transducer.moves), len(c.transducer.neighbours)) for c in bpe._codecs.values()]
        yield pa.RecordBatch.from_pydict({"codecs": [len(sizes)], "entries": pa.array([sum(map(sum, sizes))], pa.int64())})

    # Idle workers take turns, so those that have encoded are met.
    workers = spark.range(64, numPartitions=64).mapInArrow(held, "codecs long, entries long").collect()
    assert any(w["codecs"] for w in workers)
    assert not any(w["entries"] for w in workers)


def test_rare_words_are_read_together(ranks, library, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("aeioutnsrléß日") for _ in range(rng.randint(1, 20))) for _ in range(50)) for _ in range(100)]
    texts += ["", " ", "a", "x" * 300 + " zq", texts[0]]
    codec, steps = bpe.Codec(ranks, P.PATTERN, max_pieces=1000), []
    move = codec.transducer._move
    monkeypatch.setattr(codec.transducer, "_move", lambda *args: steps.append(args) or move(*args))
    for text in texts[:100]:
        assert codec.encode(text) == ",".join(map(str, library.encode_ordinary(text)))
    assert not steps  # a state for every few bytes of a rare word cost most of the time
    codec.transducer.max_moves = 500  # the table of pairs is emptied on the way
    monkeypatch.setattr(bpe, "GROUP_CHARS", 3000)
    monkeypatch.setattr(bpe, "GROUP_PIECES", 40)
    assert codec.encode_all(texts) == [",".join(map(str, library.encode_ordinary(t))) for t in texts]
    assert len(codec.pieces) + len(codec.older) <= 1000
    codec.forget()
    assert not (codec.pieces or codec.older or len(codec.transducer.pairs))


def test_short_pieces_of_a_small_vocabulary():
    rng = random.Random(6)
    for _ in range(20):
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 290:
            new = rng.choice(tokens[97:100] + tokens[256:]) + rng.choice(tokens[97:100] + tokens[256:])
            if new not in tokens:
                tokens.append(new)
        transducer = bpe.Transducer({t: k for k, t in enumerate(tokens)})
        pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 20))) for _ in range(200)]
        assert transducer.encode_together(pieces) == [transducer.encode(p) for p in pieces]


def test_number_table():
    rng, table, known = random.Random(7), bpe.NumberTable(4), {}
    for _ in range(60):
        new = {rng.randrange(1 << 40): rng.randrange(1 << 40) for _ in range(rng.randint(0, 80))}
        new = {k: v for k, v in new.items() if k not in known}
        table.add(np.array(list(new), np.int64), np.array(list(new.values()), np.int64))
        known |= new
        asked = [*known, *(rng.randrange(1 << 40) for _ in range(100))]
        assert table.get(np.array(asked, np.int64)).tolist() == [known.get(k, -1) for k in asked]
    assert len(table) == len(known)
