"""Counts, duplicates, coverage, sorting and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.enrichment import DELIVERY, delivery
from lavra.bindings.registry import query
from lavra.functions import fixed_width_key, is_usable_key, strong_name_key
from lavra.operators import (
    distinct_counts,
    duplicate_keys,
    duplicate_rows,
    duplicate_summary,
    flag_matches,
    group_counts,
    key_coverage,
    measure_keys,
    preview,
    row_coverage,
    split_by_null,
)

LINE_KEYS = ["l_orderkey", "l_linenumber"]
REPEATED = (
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
)


@query(
    "group_counts",
    "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY o_orderstatus "
    "ORDER BY n_rows DESC",
)
def group_counts_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.table(spark, sf_dir, "orders")
    return group_counts(orders, ["o_orderstatus"], [F.desc("n_rows")])


@query(
    "group_counts_multi",
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n_rows FROM lineitem
       GROUP BY ALL ORDER BY l_returnflag, l_linestatus, l_linenumber""",
)
def group_counts_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return group_counts(t.table(spark, sf_dir, "lineitem"), keys, keys)


@query(
    "no_key_types",
    f"""SELECT tipo, count(*) AS n_rows FROM ({t.COMPLAINTS}) WHERE cnpj_if IS NULL
        GROUP BY tipo ORDER BY n_rows DESC""",
)
def no_key_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, without_id = split_by_null(t.complaint_ids(spark, sf_dir), "cnpj_if")
    return group_counts(without_id, ["tipo"], [F.desc("n_rows")])


@query("duplicate_keys", REPEATED)
def duplicate_keys_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(t.table(spark, sf_dir, "lineitem"), LINE_KEYS)


@query(
    "duplicate_summary",
    f"""SELECT 'lineitem' AS dataset, count(*) AS n_keys,
               CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_rows FROM ({REPEATED})
        UNION ALL
        SELECT 'orders', count(*), CAST(coalesce(sum(n), 0) AS BIGINT)
        FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
)
def duplicate_summary_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = duplicate_summary(t.table(spark, sf_dir, "lineitem"), LINE_KEYS)
    orders = duplicate_summary(t.table(spark, sf_dir, "orders"), ["o_orderkey"])
    return lines.select(F.lit("lineitem").alias("dataset"), "*").unionByName(
        orders.select(F.lit("orders").alias("dataset"), "*")
    )


@query(
    "duplicate_detail",
    f"""SELECT l.l_orderkey, l.l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag
        FROM lineitem l JOIN ({REPEATED}) d
          ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber""",
)
def duplicate_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.table(spark, sf_dir, "lineitem").select(
        *LINE_KEYS, "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    return duplicate_rows(lines, LINE_KEYS)


@query(
    "distinct_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_tax FROM lineitem",
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.table(spark, sf_dir, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", "l_linenumber", "l_tax").distinct()


@query(
    "distinct_counts",
    f"""WITH c AS ({t.COMPLAINTS})
        SELECT 'cnpj_if' AS "column", count(DISTINCT cnpj_if) AS n_distinct,
               count(DISTINCT cnpj_if) + CAST(max(cnpj_if IS NULL) AS BIGINT)
                   AS n_distinct_with_null FROM c
        UNION ALL
        SELECT 'tipo', count(DISTINCT tipo), count(DISTINCT tipo) FROM c
        UNION ALL
        SELECT 'ano', count(DISTINCT ano), count(DISTINCT ano) FROM c""",
)
def distinct_counts_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_counts(t.complaint_ids(spark, sf_dir), ["cnpj_if", "tipo", "ano"])


@query(
    "coverage_keys",
    f"""WITH l AS (SELECT DISTINCT k FROM (
                SELECT {t.tax_key_sql("cnpj_if")} AS k FROM ({t.COMPLAINTS}))
            WHERE k IS NOT NULL AND k <> '00000000'),
        r AS (SELECT DISTINCT {t.tax_key_sql("cnpj")} AS k FROM ({t.SEGMENTS})),
        m AS (SELECT l.k, r.k IS NOT NULL AS hit FROM l LEFT JOIN r ON l.k = r.k)
        SELECT count(*) AS n_keys, count(*) FILTER (hit) AS found,
               count(*) FILTER (NOT hit) AS missing,
               round(count(*) FILTER (hit) / count(*) * 100, 6) AS coverage_percent
        FROM m""",
)
def coverage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    def usable(df: DataFrame, column: str) -> DataFrame:
        return df.select(fixed_width_key(F.col(column)).alias("key")).filter(
            is_usable_key(F.col("key"))
        )

    coverage = key_coverage(
        usable(t.complaint_ids(spark, sf_dir), "cnpj_if"),
        usable(t.segments(spark, sf_dir), "cnpj"),
        ["key"],
    )
    return coverage.withColumn("coverage_percent", F.round("coverage_percent", 6))


@query(
    "coverage_rows",
    f"""WITH names AS (SELECT DISTINCT {t.name_key_sql("nome")} AS k FROM ({t.REVIEWS})),
        m AS (SELECT names.k IS NOT NULL AS hit
              FROM (SELECT {t.name_key_sql("instituicao_financeira")} AS k
                    FROM ({t.COMPLAINTS}) WHERE cnpj_if IS NULL) f
              LEFT JOIN names ON f.k = names.k)
        SELECT count(*) AS n_rows, count(*) FILTER (hit) AS found,
               count(*) FILTER (NOT hit) AS missing,
               round(count(*) FILTER (hit) / count(*) * 100, 6) AS coverage_percent
        FROM m""",
)
def coverage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, without_id = split_by_null(t.complaints(spark, sf_dir), "cnpj_if")
    fact = without_id.select(strong_name_key(F.col("instituicao_financeira")).alias("key"))
    names = t.reviews(spark, sf_dir).select(strong_name_key(F.col("nome")).alias("key"))
    flagged = flag_matches(fact, measure_keys(names, ["key"]), "key", "hit")
    coverage = row_coverage(flagged, ["hit"])
    return coverage.withColumn("coverage_percent", F.round("coverage_percent", 6))


@query(
    "coverage_delivery",
    f"""SELECT count(*) AS n_rows,
               count(*) FILTER (encontrou_enquadramento OR encontrou_glassdoor) AS found,
               count(*) FILTER (NOT (encontrou_enquadramento OR encontrou_glassdoor)) AS missing,
               round(count(*) FILTER (encontrou_enquadramento OR encontrou_glassdoor)
                     / count(*) * 100, 6) AS coverage_percent
        FROM ({DELIVERY})""",
)
def coverage_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = ["encontrou_enquadramento", "encontrou_glassdoor"]
    coverage = row_coverage(delivery(spark, sf_dir, measured=True), flags)
    return coverage.withColumn("coverage_percent", F.round("coverage_percent", 6))


@query(
    "topn_mixed_sort",
    """SELECT c_nationkey, c_acctbal, c_custkey, c_name FROM customer
       ORDER BY c_nationkey ASC NULLS FIRST, c_acctbal DESC NULLS LAST, c_custkey LIMIT 100""",
)
def topn_mixed_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(
        t.table(spark, sf_dir, "customer"),
        100,
        ["c_nationkey", "c_acctbal", "c_custkey", "c_name"],
        [F.col("c_nationkey").asc(), F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey")],
    )


@query(
    "sorted_rows",
    """SELECT o_custkey, o_orderdate, o_orderkey FROM orders
       ORDER BY o_custkey, o_orderdate, o_orderkey""",
)
def sorted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return orders.orderBy("o_custkey", "o_orderdate", "o_orderkey")


@query(
    "in_list_filter",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND length(c_name) BETWEEN 1 AND 18""",
)
def in_list_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        t.table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment").isin("BUILDING", "FURNITURE"))
        .filter(F.length("c_name").between(1, 18))
        .select("c_custkey", "c_mktsegment")
    )


@query(
    "bool_flag_filter",
    f"""SELECT o_orderkey, metodo_enriquecimento, nome_referencia FROM ({DELIVERY})
        WHERE NOT encontrou_enquadramento AND encontrou_glassdoor
          AND metodo_enriquecimento <> 'CNPJ_ENQUADRAMENTO' AND contains(nome_referencia, '1')""",
)
def bool_flag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        delivery(spark, sf_dir, measured=True)
        .filter(~F.col("encontrou_enquadramento") & F.col("encontrou_glassdoor"))
        .filter(
            (F.col("metodo_enriquecimento") != "CNPJ_ENQUADRAMENTO")
            & F.col("nome_referencia").contains("1")
        )
        .select("o_orderkey", "metodo_enriquecimento", "nome_referencia")
    )
