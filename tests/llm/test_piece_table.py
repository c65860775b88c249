import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece
from cases import AWKWARD, docs

from tidemark.llm import catalog, piece_table


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=P.path(catalog.PIECES))


@pytest.fixture(scope="module")
def pieces():
    with open(P.path(catalog.PIECES), "rb") as f:
        return piece_table.Pieces(piece_table.read_model(f.read()))


def digests(library, text):
    ids = library.encode(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), \
        hashlib.sha256(library.decode(ids).encode()).hexdigest()


def encode(pieces, text):
    return [k for word in pieces.marked(text) for k in pieces.encode(word)]


def test_random_texts(pieces, library):
    rng = random.Random(1)
    letters = "abcdefghij éèñüß日本語🙂 \n\t\r\x0b\x0c  0123!!..''s<s></s><0x41>ZK▁ 　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "    ", "\n", "\n\n \n", "▁", "▁▁ ▁", "a\0b", "x" * 3000, "ab" * 3000, " " * 3000 + "x", "日" * 2000, "🙂" * 1000,
              "the " * 3000, "e" * 41, "supercalifragilisticexpialidocious" * 50, " \n" * 500, "=" * 700]
    for text in texts:
        ids = library.encode(text)
        assert encode(pieces, text) == ids, text
        assert "".join(pieces.decode(pieces.encode(w)) for w in pieces.marked(text))[1:] == library.decode(ids)


def test_list_and_heap_agree(pieces):
    rng = random.Random(2)
    for _ in range(500):
        word = "▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 80)))
        assert pieces._by_list(word) == pieces._by_heap(word)


def test_models_that_do_not_fit():
    from sentencepiece import sentencepiece_model_pb2 as pb
    with open(P.path(catalog.PIECES), "rb") as f:
        blob = f.read()

    def changed(change):
        model = pb.ModelProto()
        model.ParseFromString(blob)
        change(model)
        return model.SerializeToString()

    def crossing(model):
        model.pieces[1000].piece = "of▁the"

    def unigram(model):
        model.trainer_spec.model_type = 1

    def squeezing(model):
        model.normalizer_spec.remove_extra_whitespaces = True

    for change in (crossing, unigram, squeezing):
        with pytest.raises(ValueError):
            piece_table.read_model(changed(change))


def test_packing():
    import numpy as np
    for numbers in ([], [0], [1, 2, 3, 4_000_000_000], list(range(70_000))):
        assert piece_table.unpack(piece_table.pack(np.array(numbers, np.uint32))).tolist() == numbers


def expected(library, rows):
    return sorted((repr(r[0]), *digests(library, r[1]), library.encode(r[1] or "")) for r in rows)


def found(spark, rows):
    model = piece_table.share_model(spark, P.path(catalog.PIECES))
    out = piece_table.encode_documents(docs(spark, rows), model, with_ids=True).collect()
    return sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.token_ids)) for r in out)


def test_awkward(spark, library):
    assert found(spark, AWKWARD) == expected(library, AWKWARD)
    assert found(spark, []) == [] and found(spark, [(1, None, None, None)] * 3) == expected(library, [(1, None)] * 3)


def test_small_batches(spark, library, pieces, monkeypatch):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["the", "of", "münchen", "x\ny", ""]) + str(rng.randint(0, 30)) for _ in range(rng.randint(0, 90))))
            for k in range(60)]
    for name, value in (("BATCH_CHARS", 900), ("ROW_NUMBERS", 50), ("LAZY_CHARS", 100), ("JOIN_WORDS", 7), ("MAX_KNOWN", 5)):
        monkeypatch.setattr(piece_table, name, value)
    packed = list(piece_table._pack_batches(iter(rows), pieces, 4))
    assert len({r[0] for r in packed}) > 3
    words = sorted((r[0], r[1], r[4], r[5]) for r in packed if r[1] >= 0)
    ids = list(piece_table._segment_words(iter(words), pieces))
    out = []
    for batch in {r[0] for r in packed}:
        out += piece_table._put_back([(r[2], r[3], r[4]) for r in packed if r[0] == batch and r[1] < 0],
                                     [r[1:] for r in ids if r[0] == batch], pieces, True)
    assert sorted(out) == [(k, *digests(library, t), library.encode(t)) for k, t in rows]


def test_numbers_are_not_shuffled(spark, sf_small):
    import contextlib
    import io
    model = piece_table.share_model(spark, P.path(catalog.PIECES))
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        piece_table.encode_documents(spark.read.parquet(f"{sf_small}/documents.parquet"), model).explain()
    assert plan.getvalue().count("Exchange hashpartitioning") == 2  # words to buckets, ids to batches
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_pieces")]


def test_query(spark, sf_small, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    out = catalog.op12_chunk_table(spark, sf_small).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == {i: digests(library, t) for i, t in texts.items()}
