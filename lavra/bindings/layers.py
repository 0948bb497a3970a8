"""The layered jobs, from text files to the delivery, on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.enrichment import DELIVERY, delivery
from lavra.bindings.registry import query
from lavra.bindings.text import comma_decimal
from lavra.functions import fixed_width_key, folder_name
from lavra.operators import Gate, expect
from lavra.plans import (
    complaint_gates,
    delivery_gates,
    ingest,
    ingest_group,
    join_keys_profile,
    join_trial,
    materialize_final,
    read_complaint_slices,
    replacement_profile,
    segment_profile,
    strategy_profile,
    totals_from,
    trusted_complaints,
    trusted_reviews,
    trusted_segments,
    unique_keys,
    validate_layers,
    validate_raw,
)
from lavra.plans import contract
from lavra.plans.delivery import NAME_KEY, TAX_KEY, canonical_reviews, canonical_segments
from lavra.session import scratch_path
from lavra.sources import SourceSpec, read_delimited, write_delimited



YEAR = "coalesce(cast(ano AS string), 'undated')"
YEAR_SQL = "coalesce(CAST(year(o_orderdate) AS VARCHAR), 'undated')"


def export_periods(
    spark: SparkSession, sf_dir: str, spoilt: dict[str, Column] | None = None
) -> tuple[list[SourceSpec], str]:
    """Orders as one folder of ``;`` separated Latin-1 text per year, 14 columns and a blank.

    There is a source for every year of the orders, undated ones included, and each expects
    the rows that were exported. ``spoilt`` gives text to put in a column where it is not NULL.
    """
    base = scratch_path(spark, "periods")
    number = F.col("o_orderkey").cast("string")
    layout = {
        "Ano": F.concat(F.lit(" "), F.col("ano").cast("string")),
        "Trimestre": F.concat(F.col("trimestre").cast("string"), F.lit("º")),
        "Categoria": F.when(F.col("tipo") == "O", "   ").otherwise("Top \u0096 10"),
        "Tipo": F.col("tipo"),
        "CNPJ IF": F.col("cnpj_if"),
        "Instituição financeira": F.col("instituicao_financeira"),
        "Índice": F.when(F.col("tipo") != "F", comma_decimal("indice")),
        **{f"Quantidade {i}": F.concat(number, F.lit(str(i))) for i in range(1, 8)},
        "_c14": F.lit(None).cast("string"),
    }
    for name, text in (spoilt or {}).items():
        layout[name] = F.coalesce(text, layout[name])
    rows = t.complaints(spark, sf_dir).select(
        *[value.alias(name) for name, value in layout.items()],
        F.concat(F.expr(YEAR), F.lit(".csv")).alias("file"),
    )
    write_delimited(rows, base, ";", "ISO-8859-1", ["file"])
    years = t.complaint_ids(spark, sf_dir).groupBy(F.expr(YEAR).alias("year")).count().orderBy("year")
    specs = [
        SourceSpec(
            f"file={row['year']}.csv", "reclamacoes", row["year"], ";", "ISO-8859-1", row["count"]
        )
        for row in years.collect()
    ]
    return specs, base


@query(
    "raw_ingest",
    f"""WITH o AS (SELECT {YEAR_SQL} AS y FROM orders)
        SELECT coalesce('file=' || y || '.csv: rows stored', 'total') AS "check",
               count(*) AS actual, count(*) AS expected, TRUE AS ok
        FROM o GROUP BY ROLLUP (y)""",
)
def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs, base = export_periods(spark, sf_dir)
    return ingest(spark, specs, base, scratch_path(spark, "raw"))


@query(
    "raw_validation",
    f"""WITH o AS (SELECT 'reclamacoes/' || {YEAR_SQL} AS y FROM orders)
        SELECT coalesce(y, 'total') AS "check", count(*) AS actual, count(*) AS expected,
               TRUE AS ok
        FROM o GROUP BY ROLLUP (y)
        UNION ALL
        SELECT y || ': _c14 filled', 0, 0, TRUE FROM (SELECT DISTINCT y FROM o)""",
)
def raw_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs, base = export_periods(spark, sf_dir)
    raw = scratch_path(spark, "raw")
    ingest(spark, specs, base, raw)
    return validate_raw(spark, specs, raw, {"reclamacoes": contract.TRAILING_COLUMN})


TRUSTED = f"""
    SELECT ano, trimestre, CASE WHEN tipo <> 'O' THEN 'Top – 10' END AS categoria, tipo,
           {t.digits_sql("cnpj_if")} AS cnpj_if,
           trim(instituicao_financeira, ' ') AS instituicao_financeira,
           CASE WHEN tipo <> 'F' THEN indice END AS indice,
           o_orderkey * 10 + 1 AS qtd_reclamacoes_reguladas_procedentes,
           o_orderkey * 10 + 2 AS qtd_reclamacoes_reguladas_outras,
           o_orderkey * 10 + 3 AS qtd_reclamacoes_nao_reguladas,
           o_orderkey * 10 + 4 AS qtd_total_reclamacoes,
           o_orderkey * 10 + 5 AS qtd_total_clientes_ccs_scr,
           o_orderkey * 10 + 6 AS qtd_clientes_ccs,
           o_orderkey * 10 + 7 AS qtd_clientes_scr,
           'file=' || coalesce(CAST(ano AS VARCHAR), 'undated') || '.csv' AS arquivo_origem
    FROM ({t.COMPLAINTS})
"""


@query(
    "raw_group_ingest",
    f"""WITH o AS (SELECT {YEAR_SQL} AS y FROM orders)
        SELECT 'rows stored' AS "check", count(*) AS actual, count(*) AS expected, TRUE AS ok
        FROM o
        UNION ALL SELECT 'sources stored', count(DISTINCT y), count(DISTINCT y), TRUE FROM o
        UNION ALL SELECT 'malformed lines', 0, 0, TRUE
        UNION ALL SELECT 'file=' || y || '.csv: rows', count(*), count(*), TRUE FROM o GROUP BY y""",
)
def raw_group_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs, base = export_periods(spark, sf_dir)
    path = scratch_path(spark, "raw-group")
    return ingest_group(
        spark, specs, contract.COMPLAINT_COLUMNS, base, path, contract.SOURCE_COLUMN, folder_name()
    )


def trusted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """The trusted complaints and the number of their sources."""
    specs, base = export_periods(spark, sf_dir)
    raw = scratch_path(spark, "raw")
    ingest(spark, specs, base, raw)
    return trusted_complaints(read_complaint_slices(spark, raw, specs)), len(specs)


@query("raw_to_trusted", TRUSTED)
def raw_to_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted(spark, sf_dir)[0]


@query(
    "trusted_gates",
    """SELECT 'complaint rows' AS "check", count(*) AS actual, CAST(918 AS BIGINT) AS expected,
              count(*) = 918 AS ok FROM orders
       UNION ALL
       SELECT 'years outside domain',
              count(*) - count(*) FILTER (year(o_orderdate) IN (1995, 1996)), 0,
              count(*) = count(*) FILTER (year(o_orderdate) IN (1995, 1996)) FROM orders
       UNION ALL
       SELECT 'quarters outside domain', count(*) - count(o_orderdate), 0,
              count(*) = count(o_orderdate) FROM orders
       UNION ALL
       SELECT 'source files', count(DISTINCT coalesce(year(o_orderdate), 0)),
              count(DISTINCT coalesce(year(o_orderdate), 0)), TRUE FROM orders""",
)
def trusted_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, sources = trusted(spark, sf_dir)
    return expect(table, complaint_gates(918, sources, [1995, 1996]))


def _segment_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "segments")
    rows = t.segments(spark, sf_dir).select(
        F.concat(F.lit(" "), F.col("segmento")).alias("Segmento"),
        F.concat(F.col("cnpj"), F.lit("/")).alias("CNPJ"),
        F.col("nome").alias("Nome"),
    )
    write_delimited(rows, path, "\t")
    return read_delimited(spark, path, "\t")


@query("trusted_segments", t.SEGMENTS)
def trusted_segments_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_segments(_segment_file(spark, sf_dir))


@query(
    "segment_profile",
    f"""WITH s AS ({t.SEGMENTS})
        SELECT 'segmento' AS item, 'nulls' AS measure, count(*) - count(segmento) AS value FROM s
        UNION ALL SELECT 'cnpj', 'nulls', count(*) - count(cnpj) FROM s
        UNION ALL SELECT 'nome', 'nulls', count(*) - count(nome) FROM s
        UNION ALL SELECT 'segmento', 'distinct', count(DISTINCT segmento) FROM s
        UNION ALL SELECT 'cnpj', 'distinct', count(DISTINCT cnpj) FROM s
        UNION ALL SELECT segmento, 'rows', count(*) FROM s GROUP BY segmento""",
)
def segment_profile_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    nulls, distinct, per_segment = segment_profile(t.segments(spark, sf_dir))

    def laid_out(df: DataFrame, item: str, measure: str, value: str) -> DataFrame:
        return df.select(
            F.col(item).alias("item"), F.lit(measure).alias("measure"), F.col(value).alias("value")
        )

    return (
        laid_out(nulls, "column", "nulls", "n_nulls")
        .unionByName(laid_out(distinct, "column", "distinct", "n_distinct"))
        .unionByName(laid_out(per_segment, "segmento", "rows", "n_rows"))
    )


def _review_file(spark: SparkSession, sf_dir: str, last: str) -> DataFrame:
    """Parts and their attributes in the layout of the employer reviews."""
    path = scratch_path(spark, "reviews")
    text = {name: F.col(name).cast("string") for name in ("p_partkey", "p_size", "p_retailprice")}
    counts = [text["p_size"]] * 4
    scores = [text["p_retailprice"]] * 9
    founded = F.when(F.col("p_size") > 10, F.concat(text["p_size"], F.lit(".0")))
    columns = [
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")),
        *counts,
        F.lit("http://é.example"),
        F.lit(""),
        founded,
        F.col("p_type"),
        F.col("p_brand"),
        text["p_partkey"],
        *scores,
        F.concat(F.lit("#"), text["p_partkey"]),
        F.col("p_name"),
        text["p_size"],
    ]
    headers = [*[f"campo {i}" for i in range(20)], last, "Nome", "match_percent"]
    rows = t.table(spark, sf_dir, "part").select(
        *[value.alias(name) for value, name in zip(columns, headers, strict=True)]
    )
    write_delimited(rows, path, "|")
    return read_delimited(spark, path, "|")


def _reviews_sql(column: str, value: str, file: str) -> str:
    scores = ", ".join(
        f"p_retailprice AS {name}" for name in contract.REVIEW_COMMON_COLUMNS[11:20]
    )
    counts = ", ".join(
        f"CAST(p_size AS BIGINT) AS {name}" for name in contract.REVIEW_COMMON_COLUMNS[1:5]
    )
    return f"""
        SELECT p_name AS employer_name, {counts}, 'http://é.example' AS employer_website,
               CAST(NULL AS VARCHAR) AS employer_headquarters,
               CASE WHEN p_size > 10 THEN CAST(p_size AS DOUBLE) END AS employer_founded,
               p_type AS employer_industry, p_brand AS employer_revenue,
               CAST(p_partkey AS VARCHAR) AS url, {scores}, {value} AS {column},
               p_name AS nome, CAST(p_size AS DOUBLE) AS match_percent,
               '{file}' AS arquivo_origem
        FROM part
    """


@query(
    "trusted_reviews",
    _reviews_sql("segmento", "'#' || CAST(p_partkey AS VARCHAR)", contract.REVIEW_SOURCE.file),
)
def trusted_reviews_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_reviews(_review_file(spark, sf_dir, "Segmento"))


@query(
    "trusted_reviews_less",
    _reviews_sql("cnpj", "CAST(p_partkey AS VARCHAR)", contract.REVIEW_LESS_SOURCE.file),
)
def trusted_reviews_less(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trusted_reviews(_review_file(spark, sf_dir, "CNPJ"), less=True)


@query(
    "final_table",
    """SELECT 'final table: rows stored' AS "check", count(*) AS actual, count(*) AS expected,
              TRUE AS ok FROM orders
       UNION ALL SELECT 'final table: content kept', 1, 1, TRUE
       UNION ALL SELECT 'final table: columns missing', 0, 0, TRUE
       UNION ALL SELECT 'final table: columns extra', 0, 0, TRUE""",
)
def final_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "final")
    _, report = materialize_final(delivery(spark, sf_dir, measured=True), path)
    return report


@query(
    "layer_validation",
    f"""WITH c AS ({t.COMPLAINTS}), s AS ({t.SEGMENTS}), r AS ({t.REVIEWS}), d AS ({DELIVERY}),
        n AS (
            SELECT 'rows of reclamacoes' AS "check", (SELECT count(*) FROM c) AS actual,
                   (SELECT count(*) FROM orders) AS expected
            UNION ALL SELECT 'rows of enquadramento', (SELECT count(*) FROM s),
                   (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
            UNION ALL SELECT 'rows of glassdoor_match', (SELECT count(*) FROM r),
                   (SELECT count(*) FROM supplier)),
        m AS (
            SELECT * FROM n
            UNION ALL SELECT 'trusted total', sum(actual), sum(expected) FROM n
            UNION ALL SELECT 'delivery rows', (SELECT count(*) FROM d), (SELECT count(*) FROM c)
            UNION ALL SELECT 'delivery columns',
                   (SELECT count(*) FROM (DESCRIBE ({DELIVERY}))), {contract.DELIVERY_COLUMN_COUNT}
            UNION ALL SELECT 'CNPJ_ENQUADRAMENTO',
                   (SELECT count(*) FROM d WHERE metodo_enriquecimento = 'CNPJ_ENQUADRAMENTO'),
                   (SELECT count(cnpj_if) FROM c)
            UNION ALL SELECT 'NOME_GLASSDOOR',
                   (SELECT count(*) FROM d WHERE metodo_enriquecimento = 'NOME_GLASSDOOR'),
                   (SELECT count(*) - count(cnpj_if) FROM c)
            UNION ALL SELECT 'rows with segment',
                   (SELECT count(*) FROM d WHERE encontrou_enquadramento), NULL
            UNION ALL SELECT 'rows with review',
                   (SELECT count(*) FROM d WHERE encontrou_glassdoor), NULL
            UNION ALL SELECT 'rows with neither', (SELECT count(*) FROM d
                   WHERE NOT encontrou_enquadramento AND NOT encontrou_glassdoor), NULL
            UNION ALL SELECT 'U+FFFD in ' || x, 0, NULL FROM (VALUES
                   ('reclamacoes.instituicao_financeira'), ('enquadramento.nome'),
                   ('glassdoor_match.nome'), ('delivery.nome_enquadramento'),
                   ('delivery.nome_referencia')) v(x)
            UNION ALL SELECT 'U+FFFD outside the tax id branch', 0, 0)
        SELECT "check", CAST(actual AS BIGINT) AS actual, CAST(expected AS BIGINT) AS expected,
               actual = expected AS ok FROM m""",
)
def layer_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted tables and delivery against counts of the tables that they are made from."""
    tables = {
        "reclamacoes": t.complaints(spark, sf_dir),
        "enquadramento": t.segments(spark, sf_dir),
        "glassdoor_match": t.reviews(spark, sf_dir),
    }

    def rows(*names: str) -> int:
        return sum(t.table(spark, sf_dir, name).count() for name in names)

    earlier = {
        "reclamacoes": rows("orders"),
        "enquadramento": rows("customer", "supplier"),
        "glassdoor_match": rows("supplier"),
    }
    totals = totals_from(tables, earlier)
    return validate_layers(tables, delivery(spark, sf_dir, measured=True), totals=totals)


@query(
    "delivery_guards",
    f"""SELECT 'one segment per key' AS "check", CAST(0 AS BIGINT) AS actual,
               CAST(0 AS BIGINT) AS expected, TRUE AS ok
        UNION ALL SELECT 'one review per key', 0, 0, TRUE
        UNION ALL SELECT 'complaints kept', count(*), (SELECT count(*) FROM ({DELIVERY})),
               count(*) = (SELECT count(*) FROM ({DELIVERY})) FROM orders""",
)
def delivery_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What has to hold before a delivery is published: unique keys, no row gained or lost."""
    segments = canonical_segments(t.segments(spark, sf_dir))
    reviews = canonical_reviews(t.reviews(spark, sf_dir))
    n = delivery(spark, sf_dir, measured=True).count()
    kept = expect(
        t.complaint_ids(spark, sf_dir), {"complaints kept": Gate(F.count(F.lit(1)), n)}
    )
    return (
        unique_keys(segments, TAX_KEY, "one segment per key")
        .unionByName(unique_keys(reviews, NAME_KEY, "one review per key"))
        .unionByName(kept)
    )


@query(
    "column_count_gate",
    f"""SELECT 'delivery rows' AS "check", count(*) AS actual,
               (SELECT count(*) FROM orders) AS expected,
               count(*) = (SELECT count(*) FROM orders) AS ok FROM ({DELIVERY})
        UNION ALL
        SELECT 'delivery columns', count(*), {contract.DELIVERY_COLUMN_COUNT},
               count(*) = {contract.DELIVERY_COLUMN_COUNT} FROM (DESCRIBE ({DELIVERY}))""",
)
def column_count_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = delivery(spark, sf_dir, measured=True)
    rows = t.table(spark, sf_dir, "orders").count()
    return expect(table, delivery_gates(rows, len(table.columns)))


@query(
    "less_key_coverage",
    f"""WITH l AS (SELECT DISTINCT {t.tax_key_sql("url")} AS k FROM (
                SELECT CAST(s_suppkey * 3 AS VARCHAR) AS url FROM supplier)),
        usable AS (SELECT k FROM l WHERE k IS NOT NULL AND k <> '00000000'),
        s AS (SELECT DISTINCT {t.tax_key_sql("cnpj")} AS k FROM ({t.SEGMENTS})),
        m AS (SELECT usable.k, s.k IS NOT NULL AS hit FROM usable LEFT JOIN s ON usable.k = s.k)
        SELECT count(*) AS n_keys, count(*) FILTER (hit) AS found,
               count(*) FILTER (NOT hit) AS missing,
               round(count(*) FILTER (hit) / count(*) * 100, 6) AS coverage_percent
        FROM m""",
)
def less_key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    less = t.table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 3).cast("string").alias("cnpj")
    )
    complaints, segments, reviews = _profile_tables(spark, sf_dir)
    report = join_keys_profile(complaints, segments, reviews, less)["less keys in segments"]
    return report.withColumn("coverage_percent", F.round("coverage_percent", 6))


def _profile_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return t.complaints(spark, sf_dir), t.segments(spark, sf_dir), t.reviews(spark, sf_dir)


@query(
    "join_trial",
    f"""WITH fact AS (
            SELECT {t.tax_key_sql("cnpj_if")} AS k FROM ({t.COMPLAINTS})
            WHERE cnpj_if IS NOT NULL),
        joined AS (
            SELECT e.nome FROM fact LEFT JOIN ({t.CANONICAL_SEGMENTS}) e ON k = e.cnpj_chave)
        SELECT 'rows' AS "check", (SELECT count(*) FROM joined) AS actual,
               (SELECT count(*) FROM fact) AS expected,
               (SELECT count(*) FROM joined) = (SELECT count(*) FROM fact) AS ok
        UNION ALL SELECT 'matched', count(nome), NULL, NULL FROM joined
        UNION ALL SELECT 'unmatched', count(*) - count(nome), NULL, NULL FROM joined""",
)
def join_trial_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_id = t.complaint_ids(spark, sf_dir).filter(F.col("cnpj_if").isNotNull())
    fact = with_id.select(fixed_width_key(F.col("cnpj_if")).alias(TAX_KEY))
    trial = join_trial(fact, canonical_segments(t.segments(spark, sf_dir)), TAX_KEY, "nome")
    return trial["rows kept"].unionByName(trial["outcome"], allowMissingColumns=True)


@query(
    "repeated_review_names",
    f"""WITH named AS (
            SELECT {t.name_key_sql("nome")} AS nome_chave, employer_name, segmento, nome,
                   match_percent FROM ({t.REVIEWS}))
        SELECT * FROM named WHERE nome_chave IN (
            SELECT nome_chave FROM named GROUP BY nome_chave HAVING count(*) > 1)
        ORDER BY nome_chave NULLS FIRST, match_percent DESC NULLS LAST, employer_name""",
)
def repeated_review_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strategy_profile(*_profile_tables(spark, sf_dir))["rows of repeated review names"]


@query(
    "names_by_coverage",
    f"""WITH l AS (SELECT DISTINCT {t.name_key_sql("instituicao_financeira")} AS nome_chave
                  FROM ({t.COMPLAINTS}) WHERE cnpj_if IS NULL),
        r AS (SELECT DISTINCT {t.name_key_sql("nome")} AS nome_chave FROM ({t.REVIEWS}))
        SELECT nome_chave, nome_chave IN (SELECT nome_chave FROM r) AS found FROM l""",
)
def names_by_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = strategy_profile(*_profile_tables(spark, sf_dir))
    found = report["names found"].withColumn("found", F.lit(True))
    return found.unionByName(report["names not found"].withColumn("found", F.lit(False)))


@query(
    "complaints_without_segment",
    f"""WITH fact AS (
            SELECT DISTINCT {t.tax_key_sql("cnpj_if")} AS cnpj_chave, cnpj_if,
                   instituicao_financeira FROM ({t.COMPLAINTS})),
        known AS (SELECT {t.tax_key_sql("cnpj")} AS k FROM ({t.SEGMENTS}))
        SELECT * FROM fact WHERE cnpj_chave IS NOT NULL AND cnpj_chave <> '00000000'
          AND cnpj_chave NOT IN (SELECT k FROM known WHERE k IS NOT NULL)
        ORDER BY cnpj_chave, cnpj_if, instituicao_financeira""",
)
def complaints_without_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    complaints, segments, reviews = _profile_tables(spark, sf_dir)
    report = join_keys_profile(complaints, segments, reviews, segments)
    return report["complaints without segment"]


@query(
    "replacement_scan",
    f"""SELECT 'broken segments' AS dataset, 'nome' AS "column",
               count(*) FILTER (contains(nome, 'r')) AS n_rows FROM ({t.SEGMENTS})
        UNION ALL
        SELECT 'broken documents', 'text', count(*) FILTER (contains(text, 'é'))
        FROM documents""",
)
def replacement_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = t.table(spark, sf_dir, "documents").select(
        "lang", F.translate("text", "é", "�").alias("text")
    )
    segments = t.segments(spark, sf_dir).withColumn("nome", F.translate("nome", "r", "�"))
    datasets = {"broken documents": documents, "broken segments": segments}
    return replacement_profile(datasets)["cells per column"]
