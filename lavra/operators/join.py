"""Joins of a large table with a reference, and of key sets.

All joins are on equal keys. A reference is broadcast only when its rows and
bytes were measured (``measure_reference``) and are under a limit; otherwise the
tables are shuffled. A shuffled join here also compares a hash of the key, which
keeps Spark from reusing an earlier partitioning by the key. Each side then has
its own shuffle directly below the join, and that is the shape in which adaptive
execution splits an oversized partition: one key may hold a large part of the table.
Rows without a key match nothing; in a left join they are dealt out by a hash of their other
columns, so that they need no partition of their own, with or without adaptive execution.

A measured reference also knows how many of its keys repeat, so that planning a join starts
no job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lavra.functions.text import named
from lavra.session import scratch_path

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000

_HASH = "_key_hash"
_NTH = "_nth_of_key"


@dataclass(frozen=True)
class Reference:
    """A stored reference table whose size is known."""

    table: DataFrame
    rows: int
    bytes: int
    path: str
    keys: tuple[str, ...] = ()
    with_key: int = 0
    repeated: int = 0

    def require_unique(self, on: Sequence[str]) -> None:
        """A key that the reference holds twice would multiply rows: an error.

        For the keys it was measured with this is known; for others they are counted.
        """
        if set(on) == set(self.keys):
            unique = not self.repeated
        else:
            held = self.table.na.drop(subset=list(on)).groupBy(*on).count()
            unique = held.filter("count > 1").limit(1).isEmpty()
        if not unique:
            raise ValueError(f"the reference holds a key of {', '.join(on)} more than once")

    def key_gates(self, label: str) -> DataFrame:
        """Report: no key repeats, from what was counted while the reference was stored."""
        if not self.keys:
            raise ValueError("the reference was measured without its keys")
        row = (label, self.repeated, 0, self.repeated == 0)
        return self.table.sparkSession.createDataFrame(
            [row], "check string, actual long, expected long, ok boolean"
        )

    def fits_broadcast(
        self, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS
    ) -> bool:
        return self.bytes <= max_bytes and self.rows <= max_rows


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of the bytes one row takes in memory, uncompressed."""
    variable = 0
    fixed = 0
    parts = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
            variable += 1
        elif isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            fixed += 1
        else:
            parts.append(F.octet_length(F.to_json(F.struct(field.name))))
            variable += 1
    total: Column = F.lit(16 + 16 * variable + 16 * fixed)
    for part in parts:
        total = total + part
    return total.cast("long")


def measure_reference(
    df: DataFrame, path: str | None = None, on: str | Sequence[str] = ()
) -> Reference:
    """Store a reference table and measure it in the same job.

    The file size alone proves nothing (a repeated value compresses to almost
    nothing), so the bytes are summed over the rows as they are written. With ``on`` the rows
    that hold these keys, and those that repeat one, are counted on the way: a table that was
    chosen by key is already dealt out by it, so that takes no shuffle of its own.
    """
    spark = df.sparkSession
    keys = (on,) if isinstance(on, str) else tuple(on)
    path = path or scratch_path(spark, "reference")
    seen = Observation()
    measures = [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"),
    ]
    rows = df
    if keys:
        rows = df.withColumn(_NTH, F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))
        keyed = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)) == F.lit(False)
        measures += [
            F.count_if(keyed).alias("with_key"),
            F.count_if(keyed & (F.col(_NTH) > 1)).alias("repeated"),
        ]
    rows = rows.observe(seen, *measures)
    (rows.drop(_NTH) if keys else rows).write.mode("overwrite").parquet(path)
    size = seen.get
    table = spark.read.schema(df.schema).parquet(path)
    return Reference(
        table,
        size["rows"],
        size["bytes"],
        path,
        keys,
        size.get("with_key", 0),
        size.get("repeated", 0),
    )


def measure_keys(df: DataFrame, on: Sequence[str]) -> Reference:
    """Store and measure the distinct keys of a table."""
    return measure_reference(df.select(*on).distinct(), on=on)


def measure_references(
    *tables: DataFrame, on: Sequence[str | Sequence[str]] | None = None
) -> list[Reference]:
    """Store and measure several references at the same time, each ``on`` its keys."""
    keys = on or [()] * len(tables)
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(lambda t, k: measure_reference(t, on=k), tables, keys))


def split_by_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a value and rows without."""
    return df.filter(F.col(column).isNotNull()), df.filter(F.col(column).isNull())


def require_same_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> None:
    """Keys of different types are an error, whatever the sizes."""
    for key in on:
        here, there = left.schema[key].dataType, right.schema[key].dataType
        if here != there:
            raise TypeError(f"key {key} is {here.simpleString()} and {there.simpleString()}")


def without_key(on: Sequence[str]) -> Column:
    """Whether a row lacks one of the keys, and so matches nothing."""
    return F.greatest(*[named(key).isNull() for key in on], F.lit(False))


def spread_hash(df: DataFrame, on: Sequence[str]) -> Column:
    """A hash of the key, or of the whole row where it lacks a key.

    It depends on the row alone, so a task that runs again deals it out the same way. Columns
    without an order (maps) are left out.
    """
    others = [
        named(f.name)
        for f in df.schema.fields
        if f.name not in on and not _holds_map(f.dataType)
    ]
    if not others:
        return F.xxhash64(*[named(key) for key in on])
    return F.when(without_key(on), F.xxhash64(*others)).otherwise(
        F.xxhash64(*[named(key) for key in on])
    )


def _holds_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or kind.simpleString() == "variant"


def _shuffled_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    require_same_types(left, right, on)
    hashed = F.xxhash64(*on)
    dealt = spread_hash(left, on) if how == "left" else hashed
    joined = left.withColumn(_HASH, dealt).join(
        right.withColumn(_HASH, hashed), [_HASH, *on], how
    )
    return joined.drop(_HASH)


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left table whose key the right one has; columns stay in order."""
    return _shuffled_join(left, right, on, "left_semi").select(*left.columns)


def enrich_left(
    fact: DataFrame,
    reference: DataFrame | Reference,
    on: str | Sequence[str],
    columns: Mapping[str, str],
    flag: str | None = None,
    flag_from: str | None = None,
) -> DataFrame:
    """Keep every fact row and add columns of the reference row with the same key.

    The reference must hold each key once (see ``canonical``), so the number of
    rows does not change; a measured one that does not is refused. ``columns`` maps reference columns to output names. The
    key columns come first in the result. ``flag`` adds a boolean: by default
    whether the key was found; with ``flag_from`` whether that output column has
    a value (a reference row with a NULL there then counts as not found).
    """
    keys = [on] if isinstance(on, str) else list(on)
    table = reference.table if isinstance(reference, Reference) else reference
    wanted = [F.col(source).alias(target) for source, target in columns.items()]
    marker = [F.lit(True).alias("_found")] if flag and not flag_from else []
    right = table.filter(F.expr(" AND ".join(f"`{key}` IS NOT NULL" for key in keys))).select(
        *keys, *wanted, *marker
    )
    require_same_types(fact, right, keys)
    if isinstance(reference, Reference):
        reference.require_unique(keys)
    if isinstance(reference, Reference) and reference.fits_broadcast():
        joined = fact.join(F.broadcast(right), keys, "left")
    elif isinstance(reference, Reference):
        joined = _shuffled_join(fact, right.hint("merge"), keys, "left")
    else:
        joined = _shuffled_join(fact, right, keys, "left")
    order = [*keys, *[name for name in fact.columns if name not in keys], *columns.values()]
    if flag:
        found = F.col(flag_from or "_found").isNotNull()
        return joined.select(*order, found.alias(flag))
    return joined.select(*order)


def flag_matches(
    fact: DataFrame, reference: DataFrame | Reference, on: str | Sequence[str], flag: str
) -> DataFrame:
    """Every fact row with whether its key is among the keys of the reference.

    A measured reference (``measure_keys``) must hold each key once.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if isinstance(reference, DataFrame):
        reference = reference.select(*keys).distinct()
    return enrich_left(fact, reference, keys, {}, flag=flag)


def matched_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of the left table that the right one has too."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), list(on), "left_semi")


def unmatched_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of the left table that the right one lacks (NULL among them)."""
    return left.select(*on).distinct().join(right.select(*on).distinct(), list(on), "left_anti")


def unmatched_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of the left table whose key is not NULL and not in the right one."""
    with_key = left.filter(F.expr(" AND ".join(f"`{key}` IS NOT NULL" for key in on)))
    keys = right.select(*on).distinct()
    return _shuffled_join(with_key, keys, on, "left_anti").select(*left.columns)
