"""The queries ``opN_<name>``: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import (
    alignment,
    fingerprint,
    hard_negatives,
    language,
    lm,
    packing,
    pieces,
    secret_spans,
    shingle_join,
    token_files,
    toxicity,
    vectors,
    warc,
)
from lavra.llm.common import documents, held_out
from lavra.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Of the operators one can be told in SQL as a whole; of three, some columns, for which there
#: are queries of their own. tests/llm holds brute-force versions of the rest.
ORACLES: dict[str, str] = {
    "op11_hard_negatives": """
        WITH part AS (
            SELECT vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), score AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
                   CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
            FROM part a, part r
            WHERE a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
        ), positive AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score
            FROM score WHERE same
            QUALIFY row_number() OVER (
                PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (
                   PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id
               ) AS INTEGER) AS rank,
               n.other_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positive p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.same
         AND 50 * p.positive_score <= 100 * n.score
         AND 100 * n.score <= 95 * p.positive_score
        QUALIFY rank <= 3
    """,
    "secret_base_counts": r"""
        SELECT doc_id,
               len(list_filter(regexp_extract_all(coalesce(text, ''),
                   '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)',
                   1), lambda x: length(x) >= 6)) AS n_assign,
               len(list_filter(regexp_extract_all(coalesce(text, ''), 'AKIA[A-Z0-9]+'),
                   lambda x: length(x) >= 20)) AS n_access,
               len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9a-f]+'),
                   lambda x: length(x) >= 24)) AS n_hex
        FROM documents
    """,
    "edited_texts": """
        WITH t AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n
            FROM documents
        ), paired AS (
            SELECT doc_id, text, n,
                   coalesce(lead(text) OVER (ORDER BY doc_id DESC),
                            first_value(text) OVER (ORDER BY doc_id DESC)) AS following
            FROM t
        )
        SELECT doc_id, n AS n_chars,
               sha256(substr(text, 1, n - n // 3) || substr(following, 1, n // 3)) AS edited_sha256
        FROM paired
    """,
    "archive_records": """
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
               CASE WHEN page_id = max(page_id) OVER w THEN 'response' ELSE 'revisit' END
                   AS record_type,
               nullif(max(page_id) OVER w, page_id) AS refers_to
        FROM pages WINDOW w AS (PARTITION BY coalesce(html, ''))
    """,
}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.train_language_model(docs.filter(~held_out("doc_id", 4, 2)))
    return language.label_languages(docs, model, ["doc_id"]).select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "lang_pred",
        "score",
        F.size("spans").alias("n_spans"),
    )


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans.find_secrets(documents(spark, sf_dir)).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        secret_spans.spans_text().alias("spans"),
        "n_entropy",
    )


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.with_responses(documents(spark, sf_dir, "pages"))
    path = scratch_path(spark, "archive")
    warc.write_archive(warc.chunk_table(pages), path)
    return warc.read_archive(spark, path).select(
        F.col("key").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


@query
def op6_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_pieces(documents(spark, sf_dir), model, ids=False)


@query
def op10_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    training = docs.filter(~held_out("doc_id", 5, 0))
    model = toxicity.train_toxicity_model(toxicity.labelled_texts(training, labels))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query
def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(documents(spark, sf_dir))


@query
def op9_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(documents(spark, sf_dir, "embeddings"))


@query
def op3_shingle_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.similar_texts(documents(spark, sf_dir))


@query
def op4_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learned = ~held_out("doc_id", 7, 2)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return lm.score_texts(docs, docs.filter(learned), vocabulary, learned=learned).select(
        "doc_id",
        held_out("doc_id", 7, 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(documents(spark, sf_dir, "embeddings"))


@query
def op12_ranked_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(documents(spark, sf_dir), vocabulary)


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_texts(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query
def secret_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op7 that SQL can tell."""
    return op7_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex")


@query
def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op8 that SQL can tell: those of its edited texts, which need no fingerprints."""
    edited = fingerprint.edit_texts(documents(spark, sf_dir))
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))


@query
def archive_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5 that SQL can tell."""
    return op5_warc_round_trip(spark, sf_dir).select(
        "page_id", "payload_bytes", "record_type", "refers_to"
    )
