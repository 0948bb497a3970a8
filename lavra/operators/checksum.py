"""A checksum of a table's content that does not depend on the order of its rows.

Each row is hashed with the name and type of its columns, taken in the order of their names,
and with a mark for NULL; the hashes are added up, so equal rows count as often as they occur.
Hashes are cut into three lanes whose sums fit a long up to 2^41 rows, so that tasks add plain
numbers, and the lanes are put together once. Two tables of the same columns with another cell
differ in their sum but for a chance of about 1 in 2^62.

``-0.0`` counts as ``0.0`` and every NaN as the same. Arrays, maps and structs are hashed as JSON.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import named
from lavra.operators.quality import Gate, expect

LANE = 22
MODULUS = 1 << 62


def _hashable(field: T.StructField) -> Column:
    column = named(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        zero = F.lit(0.0).cast(field.dataType)
        return F.when(F.isnan(column), F.lit(float("nan")).cast(field.dataType)).otherwise(
            column + zero
        )
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(F.struct(column.alias("value")), {"ignoreNullFields": "false"})
    return column


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash of a row's named, typed columns; their order in the table is no matter."""
    chosen = sorted(columns or df.columns)
    parts: list[Column] = []
    for name in chosen:
        field = df.schema[name]
        parts.append(F.lit(f"{name} {field.dataType.simpleString()}"))
        # A NULL is passed over by the hash, so it is marked.
        parts += [named(name).isNull(), _hashable(field)]
    return F.xxhash64(*parts)


def content_sum(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Aggregate: the checksum as a long below 2^62; 0 of no rows."""
    value = row_hash(df, columns)
    mask = (1 << LANE) - 1
    total = F.lit(0).cast("decimal(38,0)")
    for lane in range(3):
        part = F.shiftrightunsigned(value, lane * LANE).bitwiseAND(F.lit(mask))
        summed = F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)")
        # 2^41 rows of 22 bits in the highest lane, moved by 44 bits, have 107 bits.
        total = total + summed * F.lit(1 << lane * LANE).cast("decimal(15,0)")
    return (total % F.lit(MODULUS).cast("decimal(20,0)")).cast("long")


def portable_sum(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Aggregate: a checksum that any SQL engine can work out, slower than ``content_sum``.

    A row is the text ``name=length:value`` of its columns in the order of their names, or
    ``name=N`` for NULL, each ended by ``;``. The first 15 hexadecimal digits of its MD5 are a
    number; the numbers are added up modulo 2^62. For text, whole numbers, decimals, dates
    and booleans, whose text is the same everywhere.
    """
    parts = []
    for name in sorted(columns or df.columns):
        kind = df.schema[name].dataType
        if not isinstance(
            kind, (T.StringType, T.IntegralType, T.DecimalType, T.DateType, T.BooleanType)
        ):
            raise TypeError(f"{name} is {kind.simpleString()}, whose text differs between engines")
        text = named(name).cast("string")
        parts.append(
            F.coalesce(
                F.concat(F.lit(f"{name}="), F.length(text).cast("string"), F.lit(":"), text),
                F.lit(f"{name}=N"),
            )
        )
        parts.append(F.lit(";"))
    digits = F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 15)
    number = F.conv(digits, 16, 10).cast("decimal(19,0)")
    total = F.coalesce(F.sum(number.cast("decimal(28,0)")), F.lit(0)).cast("decimal(38,0)")
    return (total % F.lit(MODULUS).cast("decimal(20,0)")).cast("long")


def content_gates(
    df: DataFrame, label: str, rows: int, checksum: int, columns: Sequence[str] | None = None
) -> dict[str, Gate]:
    """Gates: a table has so many rows and this checksum (1 if so); one pass for both."""
    return {
        f"{label}: rows": Gate(F.count(F.lit(1)), rows),
        f"{label}: content kept": content_gate(df, checksum, columns),
    }


def content_gate(df: DataFrame, checksum: int, columns: Sequence[str] | None = None) -> Gate:
    return Gate((content_sum(df, columns) == checksum).cast("int"), 1)


def same_content(left: DataFrame, right: DataFrame, label: str) -> DataFrame:
    """Report: rows and checksum of the right table against those of the left one."""
    row = left.agg(F.count(F.lit(1)).alias("rows"), content_sum(left).alias("sum")).first()
    return expect(right, content_gates(right, label, row["rows"], row["sum"]))
