"""Files written from the test tables and read back: charsets, lines, checksums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.registry import query
from lavra.bindings.text import COMMA_DECIMAL, comma_decimal
from lavra.functions.text import WINDOWS_1252_CHARACTERS, WINDOWS_1252_CONTROLS
from lavra.operators import blank_column, expect, stack_reports
from lavra.session import scratch_path
from lavra.sources import (
    SourceSpec,
    Reading,
    charset_probe,
    compare_manifests,
    detect_charset,
    file_manifest,
    line_counts,
    line_occurrences,
    read_delimited,
    read_group,
    read_lines,
    structure_probe,
    survey,
    write_delimited,
    write_verified,
)

LATIN = "ISO-8859-1"


def latin_orders(spark: SparkSession, sf_dir: str) -> str:
    """All orders as ``;`` separated Latin-1 text whose lines end in a separator."""
    path = scratch_path(spark, "latin-orders")
    rows = t.complaints(spark, sf_dir).select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.col("trimestre").cast("string"), F.lit("º")).alias("trimestre"),
        F.col("cnpj_if").alias("CNPJ"),
        F.concat(F.trim("instituicao_financeira"), F.lit(" \u0096 São")).alias("instituição"),
        comma_decimal("indice").alias("índice"),
        F.lit(None).cast("string").alias("_c5"),
    )
    write_delimited(rows, path, ";", LATIN)
    return path


LATIN_ORDERS = f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(trimestre AS VARCHAR) || 'º' AS trimestre,
           cnpj_if AS "CNPJ",
           trim(instituicao_financeira, ' ') || ' ' || chr(150) || ' São' AS "instituição",
           {COMMA_DECIMAL.format("indice")} AS "índice", CAST(NULL AS VARCHAR) AS _c5
    FROM ({t.COMPLAINTS})
"""


@query("csv_charset_roundtrip", LATIN_ORDERS)
def csv_charset_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_delimited(spark, latin_orders(spark, sf_dir), ";", LATIN)


@query("csv_group_scan", LATIN_ORDERS)
def csv_group_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["id", "trimestre", "CNPJ", "instituição", "índice", "_c5"]
    return read_group(spark, [latin_orders(spark, sf_dir)], names, ";", LATIN)


@query(
    "charset_probe",
    """SELECT 'ISO-8859-1' AS source, count(*) AS n_rows, 6 AS n_columns,
              'id,trimestre,CNPJ,instituição,índice,_c5' AS names, 0 AS n_hits FROM orders
       UNION ALL
       SELECT 'UTF-8', count(*), 6,
              'id,trimestre,CNPJ,institui' || repeat(chr(65533), 2) || 'o,'
              || chr(65533) || 'ndice,_c5', count(*) FROM orders""",
)
def charset_probe_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = charset_probe(spark, latin_orders(spark, sf_dir), ";", [LATIN, "UTF-8"])
    return probe.withColumn("names", F.array_join("column_names", ",")).drop("column_names")


@query(
    "charset_detection",
    f"""WITH c(charset, names, every, best) AS (VALUES
            ('UTF-8', 'id,trimestre,CNPJ,institui' || repeat(chr(65533), 2) || 'o,'
                      || chr(65533) || 'ndice,_c5', TRUE, FALSE),
            ('ISO-8859-1', 'id,trimestre,CNPJ,instituição,índice,_c5', FALSE, FALSE),
            ('windows-1252', 'id,trimestre,CNPJ,instituição,índice,_c5', FALSE, TRUE))
        SELECT charset, n AS n_rows, 6 AS n_columns, names,
               CASE WHEN every THEN n ELSE 0 END AS n_hits,
               CAST(0 AS BIGINT) AS n_malformed, best
        FROM c, (SELECT count(*) AS n FROM orders)""",
)
def charset_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_charset(spark, latin_orders(spark, sf_dir), ";")
    return found.withColumn("names", F.array_join("column_names", ",")).drop("column_names")


@query(
    "windows_1252_cells",
    f"""SELECT CAST(c_custkey AS VARCHAR) AS "código",
               c_name || chr(list_extract([{", ".join(str(ord(c)) for c in WINDOWS_1252_CHARACTERS)}],
                                          CAST(c_custkey % 27 AS INTEGER) + 1)) AS "razão – social"
        FROM customer""",
)
def windows_1252_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every character of Windows-1252 that ISO-8859-1 lacks, written as its byte and read."""
    path = scratch_path(spark, "windows")
    at = (F.col("c_custkey") % len(WINDOWS_1252_CONTROLS)).cast("int") + 1
    rows = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("código"),
        F.concat("c_name", F.substr(F.lit(WINDOWS_1252_CONTROLS), at, F.lit(1))).alias(
            "razão \u0096 social"
        ),
    )
    write_delimited(rows, path, ";", LATIN)
    return read_delimited(spark, path, ";", "windows-1252")


@query(
    "source_survey",
    """SELECT 'year ' || coalesce(CAST(year(o_orderdate) AS VARCHAR), 'undated') AS source,
              CASE WHEN year(o_orderdate) % 2 = 0 THEN 'ISO-8859-1' ELSE 'windows-1252' END
                  AS charset,
              count(*) AS n_rows, 3 AS n_columns, 'pedido,situação,valor' AS names,
              CAST(0 AS BIGINT) AS n_hits,
              count(*) FILTER (o_orderkey % 61 = 0) AS n_malformed,
              coalesce(year(o_orderdate) % 2 = 0, FALSE) AS best
       FROM orders GROUP BY year(o_orderdate)""",
)
def source_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder per year of the orders, with a separator and a charset of its own, in one scan."""
    base = scratch_path(spark, "surveyed")
    year, odd = F.year("o_orderdate"), F.year("o_orderdate") % 2 == 1
    orders = t.table(spark, sf_dir, "orders").withColumn(
        "folder", F.coalesce(year.cast("string"), F.lit("undated"))
    )
    for sep, chosen in ((";", odd | odd.isNull()), ("|", ~odd)):
        line = F.concat_ws(
            sep,
            F.col("o_orderkey").cast("string"),
            F.concat(F.lit('"ação'), F.lit(sep), F.lit('feita"')),
            F.when(F.col("o_orderkey") % 61 != 0, F.col("o_custkey").cast("string")),
        )
        rows = orders.filter(chosen).select(line.alias(sep.join(["pedido", "situação", "valor"])), "folder")
        writer = rows.write.option("header", True).option("sep", "\t").option("quote", "")
        writer.option("encoding", LATIN).partitionBy("folder").csv(f"{base}/{ord(sep)}")
    years = [row[0] for row in orders.select("folder").distinct().collect()]
    readings = [
        Reading(f"year {y}", f"{base}/124/folder={y}", "|", LATIN)
        if y.isdigit() and int(y) % 2 == 0
        else Reading(f"year {y}", f"{base}/59/folder={y}", ";", "windows-1252")
        for y in years
    ]
    found = survey(spark, readings)
    return found.withColumn("names", F.array_join("column_names", ",")).drop(
        "column_names", "n_files", "n_lines"
    )


@query(
    "structure_probe",
    """SELECT 'latin' AS source, count(*) AS n_rows, 6 AS n_columns,
              'id,trimestre,CNPJ,instituição,índice,_c5' AS names, 0 AS n_hits FROM orders
       UNION ALL
       SELECT 'latin, wrong separator', count(*), 1,
              'id;trimestre;CNPJ;instituição;índice;_c5', CAST(0 AS BIGINT) FROM orders""",
)
def structure_probe_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _, name = latin_orders(spark, sf_dir).rpartition("/")
    right = SourceSpec(name, "orders", "orders", ";", LATIN)
    wrong = SourceSpec(name, "orders", "orders", "\t", LATIN)
    probes = [
        structure_probe(spark, [spec], base).withColumn("source", F.lit(label))
        for spec, label in [(right, "latin"), (wrong, "latin, wrong separator")]
    ]
    both = probes[0].unionByName(probes[1])
    return both.withColumn("names", F.array_join("column_names", ",")).drop("column_names")


@query(
    "blank_column_check",
    """SELECT '_c5 filled' AS "check", CAST(0 AS BIGINT) AS actual, CAST(0 AS BIGINT) AS expected,
              TRUE AS ok
       UNION ALL
       SELECT 'CNPJ filled', count(*) FILTER (o_orderstatus <> 'P'), 0,
              count(*) FILTER (o_orderstatus <> 'P') = 0 FROM orders
       UNION ALL SELECT '_c9 exists', 0, 1, FALSE""",
)
def blank_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_delimited(spark, latin_orders(spark, sf_dir), ";", LATIN)
    return stack_reports([expect(raw, blank_column(raw, c)) for c in ("_c5", "CNPJ", "_c9")])


def _document_lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "document-lines")
    t.table(spark, sf_dir, "documents").select("text").write.mode("overwrite").text(path)
    return path


@query(
    "line_scan",
    """SELECT CAST(sum(1 + length(text) - length(replace(text, chr(10), ''))) AS BIGINT)
                  AS n_lines
       FROM documents""",
)
def line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = line_counts(read_lines(spark, _document_lines(spark, sf_dir)))
    return counted.agg(F.sum("n_lines").alias("n_lines"))


@query(
    "byte_pattern_count",
    """SELECT (SELECT count(*) FROM (SELECT unnest(string_split(text, chr(10))) AS line
                                     FROM documents) WHERE contains(line, 'é')) AS n_lines,
              CAST(sum(length(text) - length(replace(text, 'é', ''))) AS BIGINT)
                  AS n_occurrences
       FROM documents""",
)
def byte_pattern_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = "é".encode().decode("latin-1")
    lines = read_lines(spark, _document_lines(spark, sf_dir), LATIN)
    return line_occurrences(lines, pattern).agg(
        F.sum("n_lines").alias("n_lines"), F.sum("n_occurrences").alias("n_occurrences")
    )


@query(
    "file_manifest",
    """SELECT parse_filename(filename) AS file, size AS size_bytes,
              upper(sha256(content)) AS sha256
       FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
)
def file_manifest_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_manifest(spark, sf_dir, "*.parquet")


@query(
    "copy_verification",
    """SELECT parse_filename(filename) AS file, upper(sha256(content)) AS source_sha256,
              CASE WHEN filename NOT LIKE '%ion.parquet' THEN upper(sha256(content)) END
                  AS target_sha256,
              filename NOT LIKE '%ion.parquet' AS identical
       FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
)
def copy_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = file_manifest(spark, sf_dir, "*.parquet")
    # Hash the other side as streams, so that both ways of hashing are compared.
    target = file_manifest(spark, sf_dir, "*.parquet", whole_file_bytes=0)
    return compare_manifests(source, target.filter(~F.col("file").endswith("ion.parquet")))


@query(
    "parquet_roundtrip",
    """SELECT 'customers: rows stored' AS "check", count(*) AS actual, count(*) AS expected,
              TRUE AS ok FROM customer
       UNION ALL
       SELECT 'complaints: rows stored', count(*), count(*), TRUE FROM orders""",
)
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = t.table(spark, sf_dir, "customer")
    _, by_segment = write_verified(
        customers, scratch_path(spark, "customers"), "customers", ["c_mktsegment"]
    )
    complaints = t.complaints(spark, sf_dir)
    _, whole = write_verified(complaints, scratch_path(spark, "complaints"), "complaints")
    return stack_reports([by_segment, whole])
