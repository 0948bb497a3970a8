"""Column functions on whole tables and whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.bindings import tables as t
from lavra.bindings.registry import query
from lavra.functions import (
    clean_text,
    contains_char,
    first_integer,
    fold_accents,
    is_plain_number,
    normalized_decimal,
    number_format,
    parse_decimal,
    squeeze_spaces,
)
from lavra.functions.text import CONTROL_REPAIRS
from lavra.operators import (
    cast_columns,
    cast_rejects,
    columns_of_type,
    format_examples,
    format_profile,
    map_columns,
    rename_by_position,
)


@query(
    "clean_text",
    """SELECT doc_id,
              nullif(trim(replace(CASE WHEN lang = 'de' THEN '   '
                                       WHEN lang = 'es' THEN ''
                                       ELSE '  ' || text || ' ' END, '.', '–'), ' '), '')
                  AS text,
              nullif(trim(source, ' '), '') AS source
       FROM documents""",
)
def clean_text_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = (
        F.when(F.col("lang") == "de", "   ")
        .when(F.col("lang") == "es", "")
        .otherwise(F.concat(F.lit("  "), F.translate("text", ".", "\u0096"), F.lit(" ")))
    )
    documents = t.table(spark, sf_dir, "documents").select(
        "doc_id", dirty.alias("text"), "source"
    )
    return map_columns(
        documents, lambda c: clean_text(c, CONTROL_REPAIRS), columns_of_type(documents)
    )


@query(
    "first_int",
    """SELECT o_orderkey,
              CAST(nullif(regexp_extract(o_orderpriority, '([0-9]+)', 1), '') AS INTEGER)
                  AS priority,
              CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
              CAST(NULL AS INTEGER) AS none
       FROM orders""",
)
def first_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordinal = F.concat(F.quarter("o_orderdate").cast("string"), F.lit("º"))
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        first_integer(F.col("o_orderpriority")).alias("priority"),
        first_integer(ordinal).alias("quarter"),
        first_integer(F.col("o_orderstatus")).alias("none"),
    )


@query(
    "fold_accents",
    """SELECT doc_id,
              translate(upper(replace(text, 'ß', 'SS')), 'ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ',
                        'AAAAAEEEEIIIIOOOOOUUUUC') AS folded,
              trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS squeezed
       FROM documents""",
)
def fold_accents_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "documents").select(
        "doc_id",
        fold_accents(F.upper("text")).alias("folded"),
        squeeze_spaces(F.col("text")).alias("squeezed"),
    )


@query(
    "contains_char",
    """SELECT doc_id, coalesce(contains(text, 'é'), FALSE) AS has_accent,
              coalesce(contains(text, chr(65533)), FALSE) AS has_replacement
       FROM documents""",
)
def contains_char_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "documents").select(
        "doc_id",
        contains_char(F.col("text"), "é").alias("has_accent"),
        contains_char(F.col("text"), "�").alias("has_replacement"),
    )


@query(
    "cast_columns",
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS line,
              CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_extendedprice AS DOUBLE) AS price,
              l_returnflag AS flag
       FROM lineitem""",
)
def cast_columns_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_quantity").cast("string").alias("quantity"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_returnflag").alias("flag"),
    )
    return cast_columns(
        lines, {"long": ["l_orderkey", "line"], "double": ["quantity", "price", "not_there"]}
    )


@query(
    "cast_rejects",
    """SELECT 'mixed' AS "column", 'long' AS target_type, count(*) AS present,
              count(*) FILTER (o_orderstatus = 'F') AS rejected FROM orders
       UNION ALL
       SELECT 'o_totalprice', 'double', count(*), 0 FROM orders""",
)
def cast_rejects_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = F.when(
        F.col("o_orderstatus") == "F", F.concat(F.lit("n."), F.col("o_custkey").cast("string"))
    ).otherwise(F.col("o_custkey").cast("string"))
    orders = t.table(spark, sf_dir, "orders").select(
        mixed.alias("mixed"), F.col("o_totalprice").cast("string").alias("o_totalprice")
    )
    return cast_rejects(orders, {"long": ["mixed"], "double": ["o_totalprice"]})


def comma_decimal(column: str) -> Column:
    """A number as text with grouping points and a decimal comma."""
    return F.translate(F.format_number(column, 2), ",.", ".,")


COMMA_DECIMAL = "translate(format('{{:,.2f}}', {0}), ',.', '.,')"


@query(
    "parse_decimal_ptbr",
    f"""SELECT l_orderkey, l_linenumber, {COMMA_DECIMAL.format("l_extendedprice")} AS price_text,
               l_extendedprice AS price, l_discount AS discount
        FROM lineitem""",
)
def parse_decimal_ptbr(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        comma_decimal("l_extendedprice").alias("price_text"),
        F.col("l_discount").cast("string").alias("discount_text"),
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "price_text",
        parse_decimal(F.col("price_text")).alias("price"),
        parse_decimal(F.col("discount_text")).alias("discount"),
    )


def mixed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices, each priority class in another notation."""
    priority = F.substring("o_orderpriority", 1, 1)
    grouped = comma_decimal("o_totalprice")
    text = (
        F.when(F.col("o_orderstatus") == "P", "  ")
        .when(priority == "1", F.concat(F.lit(" "), grouped, F.lit(" ")))
        .when(priority == "2", F.replace(grouped, F.lit("."), F.lit("")))
        .when(priority == "3", F.replace(F.format_number("o_totalprice", 2), F.lit(","), F.lit("")))
        .when(priority == "4", F.col("o_custkey").cast("string"))
        .otherwise(F.concat(F.lit("n/a "), F.col("o_orderstatus")))
    )
    return t.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("indice"))


MIXED_NUMBERS = f"""
    SELECT o_orderkey, nullif(trim(
               CASE WHEN o_orderstatus = 'P' THEN '  '
                    WHEN p = '1' THEN ' ' || g || ' '
                    WHEN p = '2' THEN replace(g, '.', '')
                    WHEN p = '3' THEN format('{{:.2f}}', o_totalprice)
                    WHEN p = '4' THEN CAST(o_custkey AS VARCHAR)
                    ELSE 'n/a ' || o_orderstatus END, ' '), '') AS indice
    FROM (SELECT *, substr(o_orderpriority, 1, 1) AS p,
                 {COMMA_DECIMAL.format("o_totalprice")} AS g FROM orders)
"""

CLASSIFIED = f"""
    SELECT o_orderkey, indice,
           CASE WHEN indice IS NULL THEN 'NULO'
                WHEN regexp_matches(indice, '^-?[0-9]{{1,3}}(\\.[0-9]{{3}})+,[0-9]+$')
                    THEN 'MILHAR_PONTO_DECIMAL_VIRGULA'
                WHEN regexp_matches(indice, '^-?[0-9]+,[0-9]+$') THEN 'DECIMAL_VIRGULA'
                WHEN regexp_matches(indice, '^-?[0-9]+\\.[0-9]+$') THEN 'DECIMAL_PONTO'
                WHEN regexp_matches(indice, '^-?[0-9]+$') THEN 'INTEIRO'
                ELSE 'OUTRO_FORMATO' END AS number_format,
           CASE WHEN contains(indice, ',')
                THEN replace(replace(indice, '.', ''), ',', '.') ELSE indice END AS normalized
    FROM ({MIXED_NUMBERS})
"""


@query(
    "number_format",
    f"""SELECT o_orderkey, number_format, normalized,
               regexp_matches(normalized, '^-?[0-9]+(\\.[0-9]+)?$') AS valid
        FROM ({CLASSIFIED})""",
)
def number_format_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = map_columns(mixed_numbers(spark, sf_dir), clean_text, ["indice"])
    normalized = normalized_decimal(F.col("indice"))
    return cleaned.select(
        "o_orderkey",
        number_format(F.col("indice")).alias("number_format"),
        normalized.alias("normalized"),
        is_plain_number(normalized).alias("valid"),
    )


@query(
    "number_format_profile",
    f"""SELECT number_format, count(*) AS n_rows,
               count(*) FILTER (normalized IS NOT NULL
                   AND NOT regexp_matches(normalized, '^-?[0-9]+(\\.[0-9]+)?$')) AS n_invalid
        FROM ({CLASSIFIED}) GROUP BY number_format""",
)
def number_format_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_profile(mixed_numbers(spark, sf_dir), "indice")


@query(
    "number_format_examples",
    f"""SELECT DISTINCT indice AS original, number_format, normalized FROM ({CLASSIFIED})
        WHERE number_format IN ('MILHAR_PONTO_DECIMAL_VIRGULA', 'OUTRO_FORMATO')""",
)
def number_format_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_examples(mixed_numbers(spark, sf_dir), "indice")


@query(
    "positional_rename",
    "SELECT n_nationkey AS id, n_name AS label, c_name AS person "
    "FROM nation JOIN customer ON n_nationkey = c_nationkey",
)
def positional_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = (
        t.table(spark, sf_dir, "customer")
        .select(F.col("c_nationkey").alias("n_nationkey"), "c_name")
        .join(t.table(spark, sf_dir, "nation"), "n_nationkey")
        .select("n_nationkey", "n_name", "c_name", "n_regionkey")
    )
    return rename_by_position(joined, ["id", "label", "person", "_trailing"], drop=["_trailing"])
