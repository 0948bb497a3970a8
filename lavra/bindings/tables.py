"""The test tables seen as complaints, a segment list and employer reviews.

Orders with their customers stand for complaints: an order of status P has no tax
id, one over a price has an id too long for a key, other ids carry a mask.
Customers and suppliers form the segment list (supplier keys are customer keys too,
so keys repeat), suppliers the reviews. Customers of one market segment have ids, and
nations of two regions have names, that no complaint has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def complaint_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints without the name, for what asks for identifiers only."""
    customer_id = F.col("o_custkey").cast("string")
    tax_id = (
        F.when(F.col("o_orderstatus") == "P", None)
        .when(F.col("o_totalprice") > 490000, F.concat(F.lit("900000000"), customer_id))
        .otherwise(
            F.concat(F.substring(customer_id, 1, 1), F.lit("."), F.substr(customer_id, F.lit(2)))
        )
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.year("o_orderdate").alias("ano"),
        F.quarter("o_orderdate").alias("trimestre"),
        F.col("o_orderstatus").alias("tipo"),
        tax_id.alias("cnpj_if"),
        F.col("o_totalprice").alias("indice"),
    )


def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    return (
        complaint_ids(spark, sf_dir)
        .join(customer, "o_custkey", "left")
        .select(
            "o_orderkey",
            "ano",
            "trimestre",
            "tipo",
            "cnpj_if",
            F.concat(
                F.lit(" Natíon_"), F.col("c_nationkey").cast("string"), F.lit(" (Conglomerado) ")
            ).alias("instituicao_financeira"),
            "indice",
        )
    )


COMPLAINTS = """
    SELECT o_orderkey,
           CAST(year(o_orderdate) AS INTEGER) AS ano,
           CAST(quarter(o_orderdate) AS INTEGER) AS trimestre,
           o_orderstatus AS tipo,
           CASE WHEN o_orderstatus = 'P' THEN NULL
                WHEN o_totalprice > 490000 THEN '900000000' || CAST(o_custkey AS VARCHAR)
                ELSE substr(CAST(o_custkey AS VARCHAR), 1, 1) || '.'
                     || substr(CAST(o_custkey AS VARCHAR), 2) END AS cnpj_if,
           ' Natíon_' || CAST(c_nationkey AS VARCHAR) || ' (Conglomerado) '
               AS instituicao_financeira,
           o_totalprice AS indice
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer_id = F.col("c_custkey").cast("string")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("segmento"),
        F.when(
            F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("7"), F.lpad(customer_id, 7, "0"))
        )
        .otherwise(customer_id)
        .alias("cnpj"),
        F.when(F.col("c_acctbal") >= -500, F.col("c_name")).alias("nome"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.lit("SUPPLIER").alias("segmento"),
        F.col("s_suppkey").cast("string").alias("cnpj"),
        F.concat(F.col("s_name"), F.lit(" - Prudencial")).alias("nome"),
    )
    return customers.unionByName(suppliers)


SEGMENTS = """
    SELECT c_mktsegment AS segmento,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '7' || lpad(CAST(c_custkey AS VARCHAR), 7, '0')
                ELSE CAST(c_custkey AS VARCHAR) END AS cnpj,
           CASE WHEN c_acctbal >= -500 THEN c_name END AS nome
    FROM customer
    UNION ALL
    SELECT 'SUPPLIER', CAST(s_suppkey AS VARCHAR), s_name || ' - Prudencial' FROM supplier
"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").withColumn(
        "n_name",
        F.when(F.col("n_regionkey") >= 3, F.concat("n_name", F.lit(" (outra)"))).otherwise(
            F.col("n_name")
        ),
    )
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.concat(F.lit("S"), F.col("n_regionkey").cast("string")).alias("segmento"),
            F.col("n_name").alias("nome"),
            F.col("s_name").alias("employer_name"),
            F.col("s_suppkey").alias("reviews_count"),
            F.floor(F.col("s_acctbal") / 1000).cast("double").alias("match_percent"),
        )
    )


REVIEWS = """
    SELECT 'S' || CAST(n_regionkey AS VARCHAR) AS segmento,
           CASE WHEN n_regionkey >= 3 THEN n_name || ' (outra)' ELSE n_name END AS nome,
           s_name AS employer_name, s_suppkey AS reviews_count,
           CAST(floor(s_acctbal / 1000) AS DOUBLE) AS match_percent
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

REVIEW_OUTPUT = {
    "segmento": "segmento_glassdoor",
    "nome": "nome_glassdoor",
    "employer_name": "glassdoor_employer_name",
    "reviews_count": "glassdoor_reviews_count",
    "match_percent": "glassdoor_match_percent",
}


def digits_sql(column: str) -> str:
    return f"nullif(regexp_replace({column}, '[^0-9]', '', 'g'), '')"


def tax_key_sql(column: str) -> str:
    digits = digits_sql(column)
    return f"CASE WHEN length({digits}) <= 8 THEN lpad({digits}, 8, '0') END"


def name_key_sql(column: str) -> str:
    capitals = f"upper(trim(replace({column}, 'ß', 'SS'), ' '))"
    bare = f"regexp_replace({capitals}, '\\s*\\(CONGLOMERADO\\)\\s*$', '')"
    folded = f"translate({bare}, 'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ', 'AAAAAEEEEIIIIOOOOOUUUUC')"
    return f"trim(regexp_replace({folded}, '[^A-Z0-9]+', ' ', 'g'), ' ')"


CANONICAL_SEGMENTS = f"""
    SELECT cnpj_chave, segmento, cnpj, nome FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY cnpj_chave
                   ORDER BY CASE WHEN contains(upper(nome), 'PRUDENCIAL') THEN 2 ELSE 1 END,
                            nome NULLS FIRST, segmento NULLS FIRST, cnpj NULLS FIRST) AS rn
        FROM (SELECT *, {tax_key_sql("cnpj")} AS cnpj_chave FROM ({SEGMENTS}))
        WHERE cnpj_chave IS NOT NULL AND cnpj_chave <> '00000000')
    WHERE rn = 1
"""

CANONICAL_REVIEWS = f"""
    SELECT nome_chave, segmento, nome, employer_name, reviews_count, match_percent FROM (
        SELECT *, row_number() OVER (
                   PARTITION BY nome_chave
                   ORDER BY match_percent DESC NULLS LAST, reviews_count DESC NULLS LAST,
                            employer_name NULLS FIRST, segmento NULLS FIRST,
                            nome NULLS FIRST) AS rn
        FROM (SELECT *, {name_key_sql("nome")} AS nome_chave FROM ({REVIEWS})))
    WHERE rn = 1
"""
