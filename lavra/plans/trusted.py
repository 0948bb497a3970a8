"""Trusted layer: raw text given names, cleaned and typed in one projection per table."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import (
    clean_text,
    digits_only,
    first_integer,
    folder_name,
    parse_decimal,
)
from lavra.functions.text import CONTROL_REPAIRS
from lavra.operators.aggregate import distinct_counts, group_counts
from lavra.operators.profile import null_profile
from lavra.operators.quality import Gate, domain_breaches
from lavra.operators.quarantine import (
    Cell,
    Quarantine,
    cast_cell,
    quarantine,
    record_text,
    typed_cells,
)
from lavra.operators.shape import (
    cast_columns,
    map_columns,
    rename_by_position,
    union_strict,
    with_source,
)
from lavra.plans import contract
from lavra.sources.files import SourceSpec, read_parquet


def read_complaint_slices(
    spark: SparkSession,
    raw_base: str,
    specs: Sequence[SourceSpec] = tuple(contract.COMPLAINT_SOURCES),
) -> DataFrame:
    """All raw complaint datasets, columns named, with the file each row came from.

    Datasets of one schema are read in a single scan and told apart by their
    folder; otherwise each is read, renamed and united strictly.
    """
    paths = [spec.raw_path(raw_base) for spec in specs]
    # Each schema is a footer read by a small job; sources may be many.
    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(lambda path: spark.read.parquet(path).schema, paths))
    if all(schema == schemas[0] for schema in schemas):
        labels = F.create_map(*[F.lit(p) for s in specs for p in (s.target, s.file)])
        table = read_parquet(spark, paths, schemas[0])
        located = with_source(table, contract.SOURCE_COLUMN, labels[folder_name()])
        return rename_by_position(
            located, [*contract.COMPLAINT_COLUMNS, contract.SOURCE_COLUMN]
        )
    return union_strict(
        [
            with_source(
                rename_by_position(spark.read.parquet(path), contract.COMPLAINT_COLUMNS),
                contract.SOURCE_COLUMN,
                spec.file,
            )
            for path, spec in zip(paths, specs, strict=True)
        ]
    )


def trusted_complaints(slices: DataFrame) -> DataFrame:
    """Typed complaints from named raw slices (see ``read_complaint_slices``)."""

    def clean(name: str) -> Column:
        return clean_text(F.col(name), CONTROL_REPAIRS)

    texts = ["categoria", "tipo", "instituicao_financeira"]
    typed = {
        "ano": clean("ano").cast("int"),
        "trimestre": first_integer(clean("trimestre")),
        "cnpj_if": digits_only(clean("cnpj_if")),
        "indice": parse_decimal(clean("indice")),
        **{name: clean(name) for name in texts},
        **{name: clean(name).cast("long") for name in contract.COMPLAINT_COUNTS},
        contract.SOURCE_COLUMN: F.col(contract.SOURCE_COLUMN),
    }
    order = [name for name in contract.COMPLAINT_COLUMNS if name != contract.TRAILING_COLUMN]
    return slices.select(*[typed[n].alias(n) for n in [*order, contract.SOURCE_COLUMN]])


def quarantined_complaints(slices: DataFrame, path: str | None = None) -> Quarantine:
    """As ``trusted_complaints``, but rows with an unfit cell are set apart with the reason
    and do not end the job."""

    def clean(name: str) -> Column:
        return clean_text(F.col(name), CONTROL_REPAIRS)

    index = clean("indice")
    cells: dict[str, Column | Cell] = {
        "ano": cast_cell(clean("ano"), clean("ano").try_cast("int"), "no int"),
        "trimestre": cast_cell(
            clean("trimestre"), first_integer(clean("trimestre"), strict=False), "no integer in it"
        ),
        "cnpj_if": digits_only(clean("cnpj_if")),
        "indice": cast_cell(index, parse_decimal(index, strict=False), "no decimal"),
        **{name: clean(name) for name in ("categoria", "tipo", "instituicao_financeira")},
        **{
            name: cast_cell(clean(name), clean(name).try_cast("long"), "no long")
            for name in contract.COMPLAINT_COUNTS
        },
        contract.SOURCE_COLUMN: F.col(contract.SOURCE_COLUMN),
    }
    order = [name for name in contract.COMPLAINT_COLUMNS if name != contract.TRAILING_COLUMN]
    return quarantine(
        slices,
        {name: cells[name] for name in [*order, contract.SOURCE_COLUMN]},
        F.col(contract.SOURCE_COLUMN),
        record_text(contract.COMPLAINT_COLUMNS, ";"),
        path,
    )


def complaint_gates(
    rows: int,
    sources: int,
    years: Sequence[int] = tuple(contract.COMPLAINT_YEARS),
) -> dict[str, Gate]:
    """Row total, years and quarters in their domain, every source present."""
    return {
        "complaint rows": Gate(F.count(F.lit(1)), rows),
        "years outside domain": Gate(domain_breaches("ano", years), 0),
        "quarters outside domain": Gate(domain_breaches("trimestre", contract.QUARTERS), 0),
        "source files": Gate(F.count_distinct(contract.SOURCE_COLUMN), sources),
    }


def trusted_segments(raw: DataFrame) -> DataFrame:
    """Segment list: cleaned text, the identifier as digits."""
    named = map_columns(rename_by_position(raw, contract.SEGMENT_COLUMNS), clean_text)
    return map_columns(named, digits_only, ["cnpj"])


def segment_profile(segments: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """NULLs per column, distinct values per column, rows per segment."""
    return (
        null_profile(segments),
        distinct_counts(segments, ["segmento", "cnpj"]),
        group_counts(segments, ["segmento"], ["segmento"]),
    )


def trusted_reviews(raw: DataFrame, less: bool = False) -> DataFrame:
    """Employer reviews; the ``less`` variant has a tax id in place of the segment."""
    spec = contract.REVIEW_LESS_SOURCE if less else contract.REVIEW_SOURCE
    return with_source(
        cast_columns(_cleaned_reviews(raw, less), contract.REVIEW_TYPES),
        contract.SOURCE_COLUMN,
        spec.file,
    )


def _cleaned_reviews(raw: DataFrame, less: bool) -> DataFrame:
    names = contract.REVIEW_LESS_COLUMNS if less else contract.REVIEW_COLUMNS
    cleaned = map_columns(rename_by_position(raw, names), clean_text)
    return map_columns(cleaned, digits_only, ["cnpj"]) if less else cleaned


def quarantined_reviews(
    raw: DataFrame, less: bool = False, path: str | None = None
) -> Quarantine:
    """As ``trusted_reviews``, with rows of unfit cells set apart."""
    spec = contract.REVIEW_LESS_SOURCE if less else contract.REVIEW_SOURCE
    cleaned = _cleaned_reviews(raw, less)
    cells = typed_cells(cleaned, contract.REVIEW_TYPES)
    cells[contract.SOURCE_COLUMN] = F.lit(spec.file)
    return quarantine(
        cleaned, cells, F.lit(spec.file), record_text(cleaned.columns, spec.sep), path
    )
