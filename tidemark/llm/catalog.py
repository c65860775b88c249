"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, cap_filters, ecoc_langid, html_consensus, mixing, piece_table, prefix_trie, secrets, sharding, simhash,
    spelling_variants, stream_dedup, warc,
)
from tidemark.llm.common import materialize, read_table, scratch_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


SHARDS = 16


def op1_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.document_shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secrets.span_summary(found))


def op3_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_consensus.extract_main_text(read_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    return warc.without_gaps(warc.read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = materialize(read_table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", mixing.topic_of(text).alias("topic"), mixing.word_count(text).alias("tokens")), "mix-rows")
    return mixing.apply_mix(rows, mixing.fit(rows))


def op6_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup.exact_dedup(read_table(spark, sf_dir, "documents"), in_files=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = ecoc_langid.train(docs.where(~ecoc_langid.held_out()))
    found = ecoc_langid.identify(docs, model)
    return found.select("doc_id", ecoc_langid.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.share_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    return bpe.encode_documents(read_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def op11_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op12_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_table.share_model(spark, public_tokenizers.path(PIECES))
    return piece_table.encode_documents(read_table(spark, sf_dir, "documents"), model)


def op13_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_splitters": op1_splitters,
    "op2_secret_entropy": op2_secret_entropy,
    "op3_host_paths": op3_host_paths,
    "op4_warc": op4_warc,
    "op5_raking": op5_raking,
    "op6_stream_dedup": op6_stream_dedup,
    "op7_ecoc": op7_ecoc,
    "op8_caps": op8_caps,
    "op9_simhash": op9_simhash,
    "op10_bpe": op10_bpe,
    "op11_collapse": op11_collapse,
    "op12_chunk_table": op12_chunk_table,
    "op13_composition": op13_composition,
}

# CRC-32 of a string's UTF-8: every byte (read from hex) is followed by eight shifts.
_CRC32 = """(4294967295 - list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(regexp_extract_all(hex(encode({text})), '..'),
                    lambda c: [('0x' || c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                lambda s, y: CASE WHEN y >= 0 THEN xor(s, y) ELSE xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END) END))"""

SQL: dict[str, str] = {
    "op11_collapse": """
        WITH own AS (
            SELECT conv_id, list((coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns,
                   """ + _CRC32.format(text="conv_id::VARCHAR") + """ % 6 AS h
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        built AS (
            SELECT a.conv_id, list_concat(coalesce(b.turns, [])[:a.h], a.turns[a.h + 1:]) AS turns
            FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
        member AS (
            SELECT conv_id, d, turns[:d] AS node, turns[d][2] AS last, len(turns) = d AS ends
            FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM built)),
        node AS (
            SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(length(any_value(last)), 0) AS size,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
            FROM member GROUP BY d, node),
        child AS (SELECT node[:d - 1] AS node, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
        full_node AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (node)),
        above AS (SELECT *, node[:k] AS top FROM (SELECT *, unnest(range(d + 1)) AS k FROM full_node)),
        total AS (
            SELECT top AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
            FROM above GROUP BY top)
        SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, total.n_leaves, total.saved_tokens, n.ends_sha256
        FROM full_node n JOIN total USING (node) LEFT JOIN node p ON n.d > 0 AND p.node = n.node[:n.d - 1]""",
    "op13_composition": r"""
        WITH RECURSIVE run AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
            FROM documents),
        pair AS (SELECT doc_id, run, count(*) AS n FROM run WHERE length(run) >= 6 GROUP BY ALL),
        hashed AS (SELECT *, """ + _CRC32.format(text="(doc_id::VARCHAR || ':' || run)") + """ AS h FROM pair),
        vocabulary AS (
            SELECT word, sum(n)::BIGINT AS n
            FROM (SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        cut AS (
            SELECT word, n, place, word[:place - 1] || word[place + 1:] AS rest
            FROM (SELECT *, unnest(range(1, length(word) + 1)) AS place FROM vocabulary)),
        near AS (
            SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT cut.word, cut.n, v.word, v.n FROM cut JOIN vocabulary v ON v.word = cut.rest
            UNION SELECT v.word, v.n, cut.word, cut.n FROM cut JOIN vocabulary v ON v.word = cut.rest),
        best AS (
            SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
            FROM near GROUP BY word),
        form AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * v.n THEN other END AS form,
                   CASE WHEN other_n >= 5 * v.n THEN other_n END AS form_n
            FROM vocabulary v LEFT JOIN best USING (word)),
        walk AS (
            SELECT word, word AS root FROM form
            UNION ALL
            SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.root AND form.form IS NOT NULL)
        SELECT form.word, form.form, walk.root, form.n, form.n_near, form.form_n
        FROM form JOIN walk ON walk.word = form.word
        WHERE NOT EXISTS (SELECT 1 FROM form f WHERE f.word = walk.root AND f.form IS NOT NULL)""",
    "op8_caps": """
        WITH RECURSIVE vec AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
        reach AS (
            SELECT vec_id AS a, vec_id AS b FROM embeddings
            UNION
            SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
        component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = component.vec_id) AS n_links, component_id,
               vec_id = component_id AS kept
        FROM component""",
    "op6_stream_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
}
