"""A corpus pipeline: each stage works on what the one before kept.

toxicity        documents scored as toxic go
language        documents without a language, or of no language in most letters, go
near_duplicates one row stays of each group of near copies (five-word shingles, 0.8), that of
                the smallest id
secrets         secrets in the texts are replaced by their kind
packing         token pieces of the documents in sequences of 2048

Stages take and return the columns of documents; only the last one returns pieces. Empty
input gives empty output. Documents with a NULL id are like any other; rows of one id are
documents of their own.
"""

from __future__ import annotations

from itertools import count

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import language, packing, secret_spans, shingle_join, toxicity
from lavra.llm.common import documents, stored
from lavra.llm.components import hot_join


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = documents(spark, sf_dir, "labels")
    model = toxicity.train_toxicity_model(toxicity.labelled_texts(docs, labels))
    return toxicity.keep_harmless(docs, model)


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.train_language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that of the smallest id (NULL last), and of
    several with that id the first as stored. Rows are told apart by their place, not by their
    id, so unlike texts under one id are all kept."""
    columns = docs.columns
    place = next(name for name in map("row{}".format, count()) if name not in columns)
    rows = stored(docs.withColumn(place, F.monotonically_increasing_id()), "numbered")
    groups = shingle_join.similar_texts(rows, key=place, least=(80, 100), width=5)
    groups = groups.select(F.col("doc_id").alias(place), "component_id")
    named = hot_join(rows.select(place, F.col("doc_id").alias("id")), groups, place)
    first = F.min(F.struct(F.col("id").isNull(), "id", place)).alias("first")
    kept = named.groupBy("component_id").agg(first).select(F.col(f"first.{place}").alias("kept"))
    return rows.join(kept, rows[place] == kept["kept"], "left_semi").select(*columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_spans.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unidentified),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: The stages cannot be told in SQL; tests/llm compares the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
