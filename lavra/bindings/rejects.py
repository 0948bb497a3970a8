"""Bad cells and lines planted in the test tables, and what is told apart from the good rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.layers import TRUSTED, export_periods
from lavra.bindings.registry import query
from lavra.bindings.text import COMMA_DECIMAL
from lavra.operators import Quarantine, content_gates, expect, portable_sum, stack_reports
from lavra.plans import ingest, quarantined_complaints, read_complaint_slices, read_rejects
from lavra.session import scratch_path
from lavra.sources import SourceSpec, write_delimited, write_verified

#: Columns of the export, every how many orders a cell is bad, and what is in it then.
PLANTED = {
    "Ano": (97, "19x5"),
    "Trimestre": (101, "T"),
    "Índice": (89, "n/a"),
    "Quantidade 2": (83, "12,5"),
}
IS_GOOD = " AND ".join(f"o_orderkey % {every} <> 0" for every, _ in PLANTED.values())


def planted_quarantine(spark: SparkSession, sf_dir: str) -> tuple[Quarantine, int]:
    """The complaints with planted cells, in quarantine, and the rows that were exported."""
    spoilt = {
        name: F.when(F.col("o_orderkey") % every == 0, F.lit(text))
        for name, (every, text) in PLANTED.items()
    }
    specs, base = export_periods(spark, sf_dir, spoilt)
    raw = scratch_path(spark, "raw")
    ingest(spark, specs, base, raw)
    rows = sum(spec.expected_rows for spec in specs)
    return quarantined_complaints(read_complaint_slices(spark, raw, specs)), rows


@query("trusted_quarantine", f"{TRUSTED} WHERE {IS_GOOD}")
def trusted_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted_quarantine(spark, sf_dir)[0].good


def _cell_sql(column: str, usual: str) -> str:
    every, text = PLANTED[column]
    return f"CASE WHEN o_orderkey % {every} = 0 THEN '{text}' ELSE {usual} END"


_FIELDS = [
    _cell_sql("Ano", "CAST(ano AS VARCHAR)"),
    _cell_sql("Trimestre", "CAST(trimestre AS VARCHAR) || 'º'"),
    "CASE WHEN tipo <> 'O' THEN 'Top ' || chr(150) || ' 10' END",
    "tipo",
    "cnpj_if",
    "trim(instituicao_financeira, ' ')",
    _cell_sql("Índice", f"CASE WHEN tipo <> 'F' THEN {COMMA_DECIMAL.format('indice')} END"),
    "o_orderkey || '1'",
    _cell_sql("Quantidade 2", "o_orderkey || '2'"),
    *[f"o_orderkey || '{i}'" for i in range(3, 8)],
    "''",
]
_LINE = " || ';' || ".join(f"coalesce({field}, '')" for field in _FIELDS)
_REASONS = {
    "Ano": ("ano", "no int"),
    "Trimestre": ("trimestre", "no integer in it"),
    "Índice": ("indice", "no decimal"),
    "Quantidade 2": ("qtd_reclamacoes_reguladas_outras", "no long"),
}


@query(
    "quarantine_rejects",
    " UNION ALL ".join(
        f"""SELECT 'file=' || coalesce(CAST(ano AS VARCHAR), 'undated') || '.csv' AS source,
                   {_LINE} AS line, '{column}' AS "column", '{PLANTED[name][1]}' AS text,
                   '{reason}' AS reason
            FROM ({t.COMPLAINTS}) WHERE o_orderkey % {PLANTED[name][0]} = 0"""
        for name, (column, reason) in _REASONS.items()
    ),
)
def quarantine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted_quarantine(spark, sf_dir)[0].rejects


@query(
    "quarantine_gates",
    f"""SELECT 'complaints: good and rejected rows' AS "check", count(*) AS actual,
               count(*) AS expected, TRUE AS ok FROM orders
        UNION ALL
        SELECT 'complaints: rejected rows', count(*) FILTER (NOT ({IS_GOOD})), 0,
               count(*) FILTER (NOT ({IS_GOOD})) = 0 FROM orders""",
)
def quarantine_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts, rows = planted_quarantine(spark, sf_dir)
    return expect(parts.good, parts.gates(rows, "complaints", 0))


LONG, SHORT = 71, 73


def planted_lines(spark: SparkSession, sf_dir: str) -> tuple[list[SourceSpec], str]:
    """Orders as text, a source per status; some lines have a field too many or two too few.

    Lines are written as a table of one column whose name is the header.
    """
    base = scratch_path(spark, "lines")
    key = F.col("o_orderkey")
    short = F.concat_ws(";", key.cast("string"), F.col("o_orderpriority"))
    whole = F.concat_ws(";", short, F.col("o_custkey").cast("string"), F.lit("ação"))
    line = (
        F.when(key % LONG == 0, F.concat(whole, F.lit(";a mais")))
        .when(key % SHORT == 0, short)
        .otherwise(whole)
    )
    orders = t.table(spark, sf_dir, "orders")
    header = "pedido;prioridade;cliente;situação"
    rows = orders.select(line.alias(header), F.col("o_orderstatus").alias("file"))
    write_delimited(rows, base, "\t", "ISO-8859-1", ["file"])
    counts = orders.groupBy("o_orderstatus").count().orderBy("o_orderstatus").collect()
    specs = [
        SourceSpec(f"file={status}", "pedidos", status, ";", "ISO-8859-1", count)
        for status, count in counts
    ]
    return specs, base


@query(
    "ingest_layout",
    f"""WITH o AS (SELECT 'file=' || o_orderstatus AS y,
                          o_orderkey % {LONG} = 0 OR o_orderkey % {SHORT} = 0 AS bad FROM orders)
        SELECT coalesce(y || ': rows stored', 'total') AS "check", count(*) AS actual,
               count(*) AS expected, TRUE AS ok
        FROM o GROUP BY ROLLUP (y)
        UNION ALL
        SELECT y || ': malformed lines', count(*) FILTER (bad), 0, count(*) FILTER (bad) = 0
        FROM o GROUP BY y""",
)
def ingest_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs, base = planted_lines(spark, sf_dir)
    raw, rejects = scratch_path(spark, "raw"), scratch_path(spark, "rejects")
    return ingest(spark, specs, base, raw, rejects=rejects)


@query(
    "layout_rejects",
    f"""WITH o AS (
            SELECT 'file=' || o_orderstatus AS source, o_orderkey % {LONG} = 0 AS long,
                   o_orderkey || ';' || o_orderpriority AS short,
                   short || ';' || o_custkey || ';ação' AS whole
            FROM orders WHERE o_orderkey % {LONG} = 0 OR o_orderkey % {SHORT} = 0)
        SELECT source, CASE WHEN long THEN whole || ';a mais' ELSE short END AS line,
               CAST(NULL AS VARCHAR) AS "column",
               CASE WHEN long THEN whole ELSE short || ';;' END AS text, 'layout' AS reason
        FROM o""",
)
def layout_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs, base = planted_lines(spark, sf_dir)
    raw, rejects = scratch_path(spark, "raw"), scratch_path(spark, "rejects")
    ingest(spark, specs, base, raw, rejects=rejects)
    return read_rejects(spark, specs, rejects)


@query(
    "content_checksum",
    """WITH c AS (
            SELECT coalesce('c_custkey=' || length(CAST(c_custkey AS VARCHAR)) || ':' || c_custkey,
                            'c_custkey=N') || ';'
                || coalesce('c_mktsegment=' || length(c_mktsegment) || ':' || c_mktsegment,
                            'c_mktsegment=N') || ';'
                || coalesce('c_name=' || length(c_name) || ':' || c_name, 'c_name=N') || ';'
                || coalesce('c_nationkey=' || length(CAST(c_nationkey AS VARCHAR)) || ':'
                            || c_nationkey, 'c_nationkey=N') || ';' AS line
            FROM (SELECT * REPLACE (CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END
                                    AS c_mktsegment) FROM customer))
       SELECT count(*) AS n_rows,
              CAST(sum(CAST(('0x' || substr(md5(line), 1, 15)) AS HUGEINT))
                   % 4611686018427387904 AS BIGINT) AS checksum
       FROM c""",
)
def content_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t.table(spark, sf_dir, "customer").select(
        "c_name",
        "c_custkey",
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey",
    )
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), portable_sum(rows).alias("checksum"))


@query(
    "content_gates",
    """SELECT 'as written: rows stored' AS "check", count(*) AS actual, count(*) AS expected,
              TRUE AS ok FROM orders
       UNION ALL SELECT 'as written: content kept', 1, 1, TRUE
       UNION ALL SELECT 'one cell changed: rows', count(*), count(*), TRUE FROM orders
       UNION ALL SELECT 'one cell changed: content kept', 0, 1, FALSE""",
)
def content_gates_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written and read back, and the same with another clerk in one row."""
    orders = t.table(spark, sf_dir, "orders")
    result, stored = write_verified(orders, scratch_path(spark, "orders"), "as written", content=True)
    first = orders.agg(F.min("o_orderkey")).first()[0]
    changed = result.read(spark).withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderkey") == first, "another").otherwise(F.col("o_orderpriority")),
    )
    label = "one cell changed"
    report = expect(changed, content_gates(changed, label, result.rows, result.checksum))
    return stack_reports([stored, report])
