"""Canonical references, the two enrichments and the delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.registry import query
from lavra.functions import (
    fixed_width_key,
    priority_rank,
    segment_key,
    strong_name_key,
    weak_name_key,
)
from lavra.operators import (
    canonical,
    canonical_check,
    enrich_left,
    flag_matches,
    matched_keys,
    measure_keys,
    measure_reference,
    measure_references,
    split_by_null,
    union_filled,
    union_strict,
    unmatched_keys,
    unmatched_rows,
    with_source,
)
from lavra.plans.delivery import (
    NAME_KEY,
    TAX_KEY,
    canonical_reviews,
    canonical_segments,
    deliver,
    deliver_by_branch,
    delivery_metrics,
)

DELIVERY = f"""
    WITH fact AS ({t.COMPLAINTS}),
    enq AS ({t.CANONICAL_SEGMENTS}),
    gd AS ({t.CANONICAL_REVIEWS}),
    by_tax_id AS (
        SELECT f.*, {t.tax_key_sql("f.cnpj_if")} AS cnpj_chave FROM fact f
        WHERE cnpj_if IS NOT NULL),
    by_name AS (
        SELECT f.*, {t.name_key_sql("f.instituicao_financeira")} AS nome_chave FROM fact f
        WHERE cnpj_if IS NULL)
    SELECT a.*, e.segmento AS segmento_enquadramento, e.nome AS nome_enquadramento,
           e.nome IS NOT NULL AS encontrou_enquadramento, FALSE AS encontrou_glassdoor,
           'CNPJ_ENQUADRAMENTO' AS metodo_enriquecimento, a.cnpj_chave AS chave_integracao,
           e.segmento AS segmento_final, e.nome AS nome_referencia
    FROM by_tax_id a LEFT JOIN enq e ON a.cnpj_chave = e.cnpj_chave
    UNION ALL BY NAME
    SELECT b.*, g.segmento AS segmento_glassdoor, g.nome AS nome_glassdoor,
           g.employer_name AS glassdoor_employer_name,
           g.reviews_count AS glassdoor_reviews_count,
           g.match_percent AS glassdoor_match_percent,
           FALSE AS encontrou_enquadramento, g.employer_name IS NOT NULL AS encontrou_glassdoor,
           'NOME_GLASSDOOR' AS metodo_enriquecimento, b.nome_chave AS chave_integracao,
           g.segmento AS segmento_final, g.nome AS nome_referencia
    FROM by_name b LEFT JOIN gd g ON b.nome_chave = g.nome_chave
"""


def delivery(spark: SparkSession, sf_dir: str, measured: bool) -> DataFrame:
    segments = canonical_segments(t.segments(spark, sf_dir))
    reviews = canonical_reviews(t.reviews(spark, sf_dir))
    if measured:
        segments, reviews = measure_references(segments, reviews, on=[TAX_KEY, NAME_KEY])
    return deliver(t.complaints(spark, sf_dir), segments, reviews, t.REVIEW_OUTPUT)


@query("delivery_like", DELIVERY)
def delivery_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery(spark, sf_dir, measured=True)


@query("delivery_two_branches", DELIVERY)
def delivery_two_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = canonical_segments(t.segments(spark, sf_dir))
    reviews = canonical_reviews(t.reviews(spark, sf_dir))
    return deliver_by_branch(t.complaints(spark, sf_dir), segments, reviews, t.REVIEW_OUTPUT)


@query("delivery_one_shuffle", DELIVERY)
def delivery_one_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery(spark, sf_dir, measured=False)


@query(
    "delivery_metrics",
    f"""SELECT metodo_enriquecimento, encontrou_enquadramento, encontrou_glassdoor,
               count(*) AS n_rows
        FROM ({DELIVERY}) GROUP BY ALL""",
)
def delivery_metrics_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_metrics(delivery(spark, sf_dir, measured=True))


@query("canonical_priority", t.CANONICAL_SEGMENTS)
def canonical_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_segments(t.segments(spark, sf_dir))


@query("canonical_reviews", t.CANONICAL_REVIEWS)
def canonical_reviews_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_reviews(t.reviews(spark, sf_dir))


@query(
    "canonical_ranked",
    f"""SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, name_key FROM (
            SELECT *, row_number() OVER (
                       PARTITION BY name_key
                       ORDER BY p_retailprice DESC NULLS LAST, p_size DESC NULLS LAST,
                                p_brand NULLS FIRST, p_partkey) AS rn
            FROM (SELECT *, {t.name_key_sql("p_name")} AS name_key FROM part))
        WHERE rn = 1""",
)
def canonical_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = t.table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        "p_size",
        "p_retailprice",
        strong_name_key(F.col("p_name")).alias("name_key"),
    )
    return canonical(
        part,
        ["name_key"],
        [
            F.col("p_retailprice").desc_nulls_last(),
            F.col("p_size").desc_nulls_last(),
            F.col("p_brand").asc(),
        ],
        tie_break=["p_partkey"],
    )


@query(
    "canonical_sample",
    f"""SELECT cnpj_chave, segmento, nome FROM ({t.CANONICAL_SEGMENTS})
        WHERE segmento IN ('SUPPLIER', 'HOUSEHOLD') ORDER BY cnpj_chave""",
)
def canonical_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        canonical_segments(t.segments(spark, sf_dir))
        .filter(F.col("segmento").isin("SUPPLIER", "HOUSEHOLD"))
        .select(TAX_KEY, "segmento", "nome")
        .orderBy(TAX_KEY)
    )


@query(
    "canonical_check",
    f"""WITH keyed AS (
            SELECT {t.tax_key_sql("cnpj")} AS k FROM ({t.SEGMENTS})),
        usable AS (SELECT k FROM keyed WHERE k IS NOT NULL AND k <> '00000000'),
        kept AS (SELECT cnpj_chave AS k FROM ({t.CANONICAL_SEGMENTS}))
        SELECT (SELECT count(DISTINCT k) FROM usable) AS keys_before,
               (SELECT count(DISTINCT k) FROM kept) AS keys_after,
               (SELECT count(*) FROM (SELECT k FROM kept GROUP BY k HAVING count(*) > 1))
                   AS duplicated_after""",
)
def canonical_check_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = t.segments(spark, sf_dir)
    keyed = segments.withColumn(TAX_KEY, fixed_width_key(F.col("cnpj"))).filter(
        f"{TAX_KEY} IS NOT NULL AND {TAX_KEY} <> '00000000'"
    )
    return canonical_check(keyed, canonical_segments(segments), [TAX_KEY])


@query(
    "priority_rank",
    f"""SELECT cnpj, nome,
               CASE WHEN contains(upper(nome), 'PRUDENCIAL') THEN 2 ELSE 1 END AS prioridade
        FROM ({t.SEGMENTS})""",
)
def priority_rank_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.segments(spark, sf_dir).select(
        "cnpj", "nome", priority_rank(F.col("nome")).alias("prioridade")
    )


@query(
    "left_enrich_tax_id",
    f"""WITH fact AS (
            SELECT c.*, {t.tax_key_sql("c.cnpj_if")} AS cnpj_chave FROM ({t.COMPLAINTS}) c
            WHERE cnpj_if IS NOT NULL)
        SELECT f.*, e.segmento AS enq_segmento, e.nome AS enq_nome,
               e.cnpj_chave IS NOT NULL AS key_found
        FROM fact f LEFT JOIN ({t.CANONICAL_SEGMENTS}) e ON f.cnpj_chave = e.cnpj_chave""",
)
def left_enrich_tax_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_id, _ = split_by_null(t.complaints(spark, sf_dir), "cnpj_if")
    keyed = with_id.withColumn(TAX_KEY, fixed_width_key(F.col("cnpj_if")))
    return enrich_left(
        keyed,
        canonical_segments(t.segments(spark, sf_dir)),
        TAX_KEY,
        {"segmento": "enq_segmento", "nome": "enq_nome"},
        flag="key_found",
    )


@query(
    "left_enrich_name",
    f"""WITH fact AS (
            SELECT c.*, {t.name_key_sql("c.instituicao_financeira")} AS nome_chave
            FROM ({t.COMPLAINTS}) c WHERE cnpj_if IS NULL)
        SELECT f.*, g.segmento AS gd_segmento, g.employer_name AS gd_employer_name,
               g.match_percent AS gd_match_percent, g.employer_name IS NOT NULL AS gd_found
        FROM fact f LEFT JOIN ({t.CANONICAL_REVIEWS}) g ON f.nome_chave = g.nome_chave""",
)
def left_enrich_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, without_id = split_by_null(t.complaints(spark, sf_dir), "cnpj_if")
    keyed = without_id.withColumn("nome_chave", strong_name_key(F.col("instituicao_financeira")))
    taken = ["segmento", "employer_name", "match_percent"]
    return enrich_left(
        keyed,
        measure_reference(canonical_reviews(t.reviews(spark, sf_dir)), on=NAME_KEY),
        "nome_chave",
        {name: f"gd_{name}" for name in taken},
        flag="gd_found",
        flag_from="gd_employer_name",
    )


@query(
    "left_key_flag",
    f"""WITH fact AS (
            SELECT c.*, {t.name_key_sql("c.instituicao_financeira")} AS nome_chave
            FROM ({t.COMPLAINTS}) c WHERE cnpj_if IS NULL),
        names AS (SELECT DISTINCT {t.name_key_sql("nome")} AS nome_chave FROM ({t.REVIEWS}))
        SELECT f.o_orderkey, f.nome_chave, n.nome_chave IS NOT NULL AS has_review
        FROM fact f LEFT JOIN names n ON f.nome_chave = n.nome_chave""",
)
def left_key_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, without_id = split_by_null(t.complaints(spark, sf_dir), "cnpj_if")
    fact = without_id.select(
        "o_orderkey", strong_name_key(F.col("instituicao_financeira")).alias("nome_chave")
    )
    names = t.reviews(spark, sf_dir).select(strong_name_key(F.col("nome")).alias("nome_chave"))
    return flag_matches(fact, measure_keys(names, ["nome_chave"]), "nome_chave", "has_review")


def _customers_and_urgent(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers, and all orders: those that are not urgent ones of a year have other keys."""
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1998)
    key = F.when(urgent, F.col("o_custkey")).otherwise(-F.col("o_custkey"))
    orders = t.table(spark, sf_dir, "orders").select(key.alias("c_custkey"))
    return t.table(spark, sf_dir, "customer"), orders


URGENT = """
    SELECT CASE WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998
                THEN o_custkey ELSE -o_custkey END FROM orders
"""


@query("matched_keys", f"SELECT c_custkey FROM customer WHERE c_custkey IN ({URGENT})")
def matched_keys_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched_keys(*_customers_and_urgent(spark, sf_dir), ["c_custkey"])


@query("unmatched_keys", f"SELECT c_custkey FROM customer WHERE c_custkey NOT IN ({URGENT})")
def unmatched_keys_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unmatched_keys(*_customers_and_urgent(spark, sf_dir), ["c_custkey"])


@query(
    "unmatched_detail",
    f"""SELECT DISTINCT c_custkey, c_name, c_mktsegment FROM customer
        WHERE c_custkey NOT IN ({URGENT}) ORDER BY c_custkey, c_name""",
)
def unmatched_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, urgent = _customers_and_urgent(spark, sf_dir)
    shown = customers.select("c_custkey", "c_name", "c_mktsegment")
    return (
        unmatched_rows(shown, urgent, ["c_custkey"]).distinct().orderBy("c_custkey", "c_name")
    )


@query(
    "composite_join",
    """WITH pairs AS (
           SELECT DISTINCT upper(trim(' ' || lower(c_mktsegment) || ' ', ' ')) AS segmento_chave,
                  upper(n_name) AS nome_chave
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
       rich AS (
           SELECT DISTINCT c_mktsegment AS segmento_chave,
                  CASE WHEN c_acctbal > 9900 THEN n_name ELSE n_name || ' MENOR' END AS nome_chave
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
       SELECT p.segmento_chave, p.nome_chave, r.nome_chave IS NOT NULL AS found
       FROM pairs p LEFT JOIN rich r
         ON p.segmento_chave = r.segmento_chave AND p.nome_chave = r.nome_chave""",
)
def composite_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = t.table(spark, sf_dir, "nation")
    people = t.table(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    padded = F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" "))
    pairs = people.select(
        segment_key(padded).alias("segmento_chave"),
        weak_name_key(F.concat(F.lit("  "), F.lower("n_name"))).alias("nome_chave"),
    )
    name = F.when(F.col("c_acctbal") > 9900, F.col("n_name")).otherwise(
        F.concat("n_name", F.lit(" menor"))
    )
    rich = people.select(
        segment_key(F.col("c_mktsegment")).alias("segmento_chave"),
        weak_name_key(name).alias("nome_chave"),
    )
    keys = ["segmento_chave", "nome_chave"]
    return matched_keys(pairs, rich, keys).withColumn("found", F.lit(True)).unionByName(
        unmatched_keys(pairs, rich, keys).withColumn("found", F.lit(False))
    )


@query(
    "union_periods",
    """SELECT o_orderkey, o_custkey, o_totalprice,
              'orders_' || coalesce(CAST(year(o_orderdate) AS VARCHAR), 'undated') AS arquivo_origem
       FROM orders""",
)
def union_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd years have another order of columns than the rest, and are a table of their own."""
    orders = t.table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    source = F.concat(F.lit("orders_"), F.coalesce(year.cast("string"), F.lit("undated")))
    odd = F.coalesce(year % 2 == 1, F.lit(False))
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    slices = [
        with_source(orders.filter(kept), "arquivo_origem", source).select(
            *order, "arquivo_origem"
        )
        for kept, order in ((~odd, columns), (odd, columns[::-1]))
    ]
    return union_strict(slices)


@query(
    "union_nullfill",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment,
              NULL AS nation FROM customer
       UNION ALL
       SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def union_nullfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"),
    )
    return union_filled([customers, suppliers])
