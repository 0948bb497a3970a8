"""Join keys and profiles of identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.registry import query
from lavra.functions import (
    digits_only,
    fixed_width_key,
    is_usable_key,
    strong_name_key,
    weak_name_key,
    with_key_details,
)
from lavra.operators import key_exceptions, key_length_profile


@query(
    "digits_only",
    f"""SELECT c_custkey, {t.digits_sql("c_name")} AS from_name,
               {t.digits_sql("c_mktsegment")} AS from_segment
        FROM customer""",
)
def digits_only_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "customer").select(
        "c_custkey",
        digits_only(F.col("c_name")).alias("from_name"),
        digits_only(F.col("c_mktsegment")).alias("from_segment"),
    )


@query(
    "fixed_width_key",
    f"""SELECT o_orderkey, cnpj_if, {t.tax_key_sql("cnpj_if")} AS key
        FROM ({t.COMPLAINTS})""",
)
def fixed_width_key_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.complaint_ids(spark, sf_dir).select(
        "o_orderkey", "cnpj_if", fixed_width_key(F.col("cnpj_if")).alias("key")
    )


@query(
    "usable_keys",
    f"""SELECT cnpj, key FROM (SELECT cnpj, {t.tax_key_sql("cnpj")} AS key FROM ({t.SEGMENTS}))
        WHERE key IS NOT NULL AND key <> '00000000'""",
)
def usable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = t.segments(spark, sf_dir).select("cnpj", fixed_width_key(F.col("cnpj")).alias("key"))
    return keyed.filter(is_usable_key(F.col("key")))


@query(
    "key_details",
    f"""SELECT o_orderkey, {t.digits_sql("cnpj_if")} AS cnpj_digitos,
               CAST(length({t.digits_sql("cnpj_if")}) AS INTEGER) AS cnpj_tamanho,
               {t.tax_key_sql("cnpj_if")} AS cnpj_chave_8
        FROM ({t.COMPLAINTS})""",
)
def key_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = t.complaint_ids(spark, sf_dir).select("o_orderkey", "cnpj_if")
    return with_key_details(ids, "cnpj_if").drop("cnpj_if")


@query(
    "name_key_strong",
    f"""SELECT doc_id AS id, {t.name_key_sql("text")} AS name_key FROM documents
        UNION ALL
        SELECT o_orderkey, {t.name_key_sql("instituicao_financeira")} FROM ({t.COMPLAINTS})""",
)
def name_key_strong(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), strong_name_key(F.col("text")).alias("name_key")
    )
    names = t.complaints(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        strong_name_key(F.col("instituicao_financeira")).alias("name_key"),
    )
    return documents.unionByName(names)


@query(
    "name_key_weak",
    """SELECT doc_id AS id,
              upper(trim(regexp_replace(replace(text, 'ß', 'SS'), '\\s+', ' ', 'g'), ' '))
                  AS name_key
       FROM documents""",
)
def name_key_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), weak_name_key(F.col("text")).alias("name_key")
    )


@query(
    "name_key_examples",
    f"""SELECT DISTINCT instituicao_financeira,
               {t.name_key_sql("instituicao_financeira")} AS nome_chave
        FROM ({t.COMPLAINTS}) WHERE cnpj_if IS NULL ORDER BY nome_chave""",
)
def name_key_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        t.complaints(spark, sf_dir)
        .filter(F.col("cnpj_if").isNull())
        .select("instituicao_financeira")
        .distinct()
        .withColumn("nome_chave", strong_name_key(F.col("instituicao_financeira")))
        .orderBy("nome_chave")
    )


@query(
    "key_length_profile",
    f"""SELECT 'complaints' AS dataset, CAST(length({t.digits_sql("cnpj_if")}) AS INTEGER)
                   AS n_digits, count(*) AS n_rows
        FROM ({t.COMPLAINTS}) GROUP BY n_digits
        UNION ALL
        SELECT 'segments', CAST(length({t.digits_sql("cnpj")}) AS INTEGER) AS n, count(*)
        FROM ({t.SEGMENTS}) GROUP BY n
        UNION ALL
        SELECT 'suppliers', CAST(length({t.digits_sql("s_name")}) AS INTEGER) AS n, count(*)
        FROM supplier GROUP BY n""",
)
def key_length_profile_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    datasets = {
        "complaints": (t.complaint_ids(spark, sf_dir), "cnpj_if"),
        "segments": (t.segments(spark, sf_dir), "cnpj"),
        "suppliers": (t.table(spark, sf_dir, "supplier"), "s_name"),
    }
    profiles = [
        key_length_profile(df, column).select(F.lit(label).alias("dataset"), "*")
        for label, (df, column) in datasets.items()
    ]
    return profiles[0].unionByName(profiles[1]).unionByName(profiles[2])


@query(
    "key_exceptions",
    f"""SELECT 'complaints' AS dataset,
               count(*) FILTER (length({t.digits_sql("cnpj_if")}) > 8) AS too_long,
               count(*) FILTER ({t.tax_key_sql("cnpj_if")} = '00000000') AS reserved
        FROM ({t.COMPLAINTS})
        UNION ALL
        SELECT 'segments', count(*) FILTER (length({t.digits_sql("cnpj")}) > 8),
               count(*) FILTER ({t.tax_key_sql("cnpj")} = '00000000')
        FROM ({t.SEGMENTS})""",
)
def key_exceptions_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = key_exceptions(t.complaint_ids(spark, sf_dir), "cnpj_if")
    reference = key_exceptions(t.segments(spark, sf_dir), "cnpj")
    return fact.select(F.lit("complaints").alias("dataset"), "*").unionByName(
        reference.select(F.lit("segments").alias("dataset"), "*")
    )
