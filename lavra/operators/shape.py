"""Columns: naming, choosing, mapping, casting, comparing; and unions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.functions.files import file_name
from lavra.functions.text import named


def rename_by_position(
    df: DataFrame, names: Sequence[str], drop: Iterable[str] = ()
) -> DataFrame:
    """Give the columns new names in order, then drop some of them.

    A different number of columns is an error: the names would land on the
    wrong columns.
    """
    if len(df.columns) != len(names):
        raise ValueError(f"{len(names)} columns expected, {len(df.columns)} found: {df.columns}")
    return df.toDF(*names).drop(*drop)


def map_columns(
    df: DataFrame,
    transform: Callable[[Column], Column],
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Apply one expression to all (or the listed) columns, in one projection."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        *[
            transform(named(name)).alias(name) if name in chosen else named(name)
            for name in df.columns
        ]
    )


def with_source(df: DataFrame, column: str, value: str | Column | None = None) -> DataFrame:
    """Add where a row came from: a fixed label, or by default its file's name."""
    if value is None:
        value = file_name()
    elif isinstance(value, str):
        value = F.lit(value)
    return df.withColumn(column, value)


def columns_of_type(df: DataFrame, type_name: str = "string") -> list[str]:
    """Names of the columns of one type."""
    return [field.name for field in df.schema.fields if field.dataType.simpleString() == type_name]


def available_columns(df: DataFrame, candidates: Iterable[str]) -> list[str]:
    """Those candidates the table has, each once, in the order given."""
    return [name for name in dict.fromkeys(candidates) if name in df.columns]


def cast_columns(
    df: DataFrame,
    types: dict[str, Iterable[str]],
    strict: bool = True,
    only_existing: bool = True,
) -> DataFrame:
    """Cast the columns listed under each type name.

    Strict casts fail on a value that does not fit (in ANSI mode). With
    ``strict=False`` such a value becomes NULL; ``cast_rejects`` counts them.
    """
    target = {name: type_name for type_name, names in types.items() for name in names}
    absent = [name for name in target if name not in df.columns]
    if absent and not only_existing:
        raise ValueError(f"no such columns: {absent}")

    def converted(name: str) -> Column:
        column = named(name)
        if name not in target:
            return column
        cast = column.cast(target[name]) if strict else column.try_cast(target[name])
        return cast.alias(name)

    return df.select(*[converted(name) for name in df.columns])


def cast_rejects(df: DataFrame, types: dict[str, Iterable[str]]) -> DataFrame:
    """Per column to be cast: values present, and values that would not fit."""
    pairs = [(n, t) for t, names in types.items() for n in names if n in df.columns]
    counts = []
    for i, (name, type_name) in enumerate(pairs):
        present = named(name).isNotNull()
        counts.append(F.count_if(present).alias(f"present{i}"))
        counts.append(
            F.count_if(present & named(name).try_cast(type_name).isNull()).alias(f"rejected{i}")
        )
    return df.agg(*counts).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column"),
                        F.lit(type_name).alias("target_type"),
                        F.col(f"present{i}").alias("present"),
                        F.col(f"rejected{i}").alias("rejected"),
                    )
                    for i, (name, type_name) in enumerate(pairs)
                ]
            )
        )
    )


def union_strict(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, matched by column name; a missing column is an error."""
    return reduce(lambda top, bottom: top.unionByName(bottom), tables)


def union_filled(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; a column a table lacks is NULL for its rows."""
    return reduce(
        lambda top, bottom: top.unionByName(bottom, allowMissingColumns=True), tables
    )


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns that are missing from or extra in the right table, or typed otherwise.

    One row per difference; no rows when names and types agree.
    """
    left_types = {field.name: field.dataType.simpleString() for field in left.schema.fields}
    right_types = {field.name: field.dataType.simpleString() for field in right.schema.fields}
    rows = []
    for name in sorted({*left_types, *right_types}):
        here, there = left_types.get(name), right_types.get(name)
        if here != there:
            status = "missing" if there is None else "extra" if here is None else "type_changed"
            rows.append((name, status, here, there))
    return left.sparkSession.createDataFrame(
        rows, "column string, status string, left_type string, right_type string"
    )


def preview(
    df: DataFrame, rows: int, columns: Sequence[str] | None = None, order_by: Sequence = ()
) -> DataFrame:
    """The first rows, of some columns, in some order (a top-n, not a full sort)."""
    chosen = df.select(*columns) if columns else df
    return (chosen.orderBy(*order_by) if order_by else chosen).limit(rows)
