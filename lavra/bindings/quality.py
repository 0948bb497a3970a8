"""Profiles and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.enrichment import DELIVERY, delivery
from lavra.bindings.registry import query
from lavra.functions import contains_char
from lavra.operators import (
    Gate,
    char_rows,
    char_scan,
    column_fill,
    compare_metrics,
    domain_breaches,
    expect,
    metrics,
    null_profile,
    schema_diff,
    stack_reports,
    union_strict,
)

TEXT_TABLES = {
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "conversations": ["role", "text"],
    "benchmark": ["text"],
}


def _scan_sql(dataset: str, column: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{column}' AS \"column\", "
        f"count(*) FILTER (contains({column}, 'é')) AS n_rows FROM {dataset}"
    )


@query(
    "accent_scan",
    " UNION ALL ".join(_scan_sql(d, c) for d, columns in TEXT_TABLES.items() for c in columns),
)
def accent_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_strict(
        [
            char_scan(t.table(spark, sf_dir, name), "é").select(F.lit(name).alias("dataset"), "*")
            for name in TEXT_TABLES
        ]
    )


@query(
    "accent_rows",
    """SELECT DISTINCT lang, source, text FROM documents WHERE contains(text, 'ü')""",
)
def accent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents")
    return char_rows(documents, "text", ["lang", "absent", "source", "text"], "ü")


@query(
    "null_profile",
    f"""WITH d AS ({DELIVERY})
        SELECT 'cnpj_if' AS "column", count(*) AS n_rows, count(*) - count(cnpj_if) AS n_nulls
        FROM d
        UNION ALL SELECT 'cnpj_chave', count(*), count(*) - count(cnpj_chave) FROM d
        UNION ALL SELECT 'nome_chave', count(*), count(*) - count(nome_chave) FROM d
        UNION ALL SELECT 'segmento_final', count(*), count(*) - count(segmento_final) FROM d
        UNION ALL SELECT 'nome_referencia', count(*), count(*) - count(nome_referencia) FROM d""",
)
def null_profile_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["cnpj_if", "cnpj_chave", "nome_chave", "segmento_final", "nome_referencia"]
    return null_profile(delivery(spark, sf_dir, measured=True), columns)


@query(
    "domain_check",
    """SELECT 'years outside 1995 to 2000' AS "check",
              count(*) FILTER (year(o_orderdate) NOT IN (1995, 1996, 1997, 1998, 1999, 2000))
                  AS actual FROM orders
       UNION ALL
       SELECT 'status outside domain, NULL included', count(*) FILTER (o_orderstatus <> 'F')
       FROM orders
       UNION ALL
       SELECT 'quarters outside 1 to 4', 0""",
)
def domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
    )
    return metrics(
        orders,
        {
            "years outside 1995 to 2000": domain_breaches("year", range(1995, 2001)),
            "status outside domain, NULL included": domain_breaches("status", ["F"]),
            "quarters outside 1 to 4": domain_breaches("quarter", [1, 2, 3, 4]),
        },
    )


@query(
    "expectations_report",
    f"""WITH d AS ({DELIVERY}),
        report AS (
            SELECT 'rows' AS "check", (SELECT count(*) FROM d) AS actual,
                   (SELECT count(*) FROM orders) AS expected
            UNION ALL
            SELECT 'rows by tax id',
                   (SELECT count(*) FROM d WHERE metodo_enriquecimento = 'CNPJ_ENQUADRAMENTO'),
                   (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P')
            UNION ALL
            SELECT 'rows by name',
                   (SELECT count(*) FROM d WHERE metodo_enriquecimento = 'NOME_GLASSDOOR'),
                   (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')
            UNION ALL
            SELECT 'distinct orders', (SELECT count(DISTINCT o_orderkey) FROM d),
                   (SELECT count(DISTINCT o_orderkey) FROM orders))
        SELECT "check", actual, expected, actual = expected AS ok FROM report""",
)
def expectations_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    method = F.col("metodo_enriquecimento")
    found = metrics(
        delivery(spark, sf_dir, measured=True),
        {
            "rows": F.count(F.lit(1)),
            "rows by tax id": F.count_if(method == "CNPJ_ENQUADRAMENTO"),
            "rows by name": F.count_if(method == "NOME_GLASSDOOR"),
            "distinct orders": F.count_distinct("o_orderkey"),
        },
    )
    wanted = metrics(
        t.table(spark, sf_dir, "orders"),
        {
            "rows": F.count(F.lit(1)),
            "rows by tax id": F.count_if(F.col("o_orderstatus") != "P"),
            "rows by name": F.count_if(F.col("o_orderstatus") == "P"),
            "distinct orders": F.count_distinct("o_orderkey"),
        },
    )
    return compare_metrics(found, wanted)


@query(
    "fixed_expectations",
    """SELECT 'regions' AS "check", (SELECT count(*) FROM region) AS actual,
              CAST(5 AS BIGINT) AS expected, (SELECT count(*) FROM region) = 5 AS ok
       UNION ALL
       SELECT 'nations', (SELECT count(*) FROM nation), 25, (SELECT count(*) FROM nation) = 25
       UNION ALL
       SELECT 'orders of unknown status',
              (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')), 0,
              (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) = 0""",
)
def fixed_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.count(F.lit(1))
    return stack_reports(
        [
            expect(t.table(spark, sf_dir, "region"), {"regions": Gate(rows, 5)}),
            expect(t.table(spark, sf_dir, "nation"), {"nations": Gate(rows, 25)}),
            expect(
                t.table(spark, sf_dir, "orders"),
                {"orders of unknown status": Gate(domain_breaches("o_orderstatus", ["F", "O"]), 0)},
            ),
        ]
    )


@query(
    "stray_accents",
    """SELECT 'accents outside the prose languages' AS "check",
              count(*) FILTER (contains(text, 'é') AND lang <> 'fr' AND lang <> 'es')
                  AS actual FROM documents""",
)
def stray_accents(spark: SparkSession, sf_dir: str) -> DataFrame:
    stray = contains_char(F.col("text"), "é") & (F.col("lang") != "fr") & (F.col("lang") != "es")
    return metrics(
        t.table(spark, sf_dir, "documents"),
        {"accents outside the prose languages": F.count_if(stray)},
    )


@query(
    "schema_diff",
    """SELECT * FROM (
           SELECT 'id' AS "column", 'type_changed' AS status, 'bigint' AS left_type,
                  'string' AS right_type, (SELECT count(c_custkey) FROM customer) AS left_values,
                  (SELECT count(s_suppkey) FROM supplier) AS right_values
           UNION ALL
           SELECT 'segment', 'missing', 'string', NULL,
                  (SELECT count(c_mktsegment) FROM customer), NULL
           UNION ALL
           SELECT 'balance', 'extra', NULL, 'double', NULL,
                  (SELECT count(s_acctbal) FROM supplier))""",
)
def schema_diff_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    right = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    def fill(df: DataFrame, side: str) -> DataFrame:
        return column_fill(df).select("column", F.col("n_values").alias(f"{side}_values"))

    return (
        schema_diff(left, right)
        .join(fill(left, "left"), "column", "left")
        .join(fill(right, "right"), "column", "left")
    )
