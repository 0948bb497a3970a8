"""Diagnostic reports that justify the rules of the layers. Each maps a title to a table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions import (
    fixed_width_key,
    is_usable_key,
    segment_key,
    strong_name_key,
    weak_name_key,
    with_key_details,
)
from lavra.functions.numeric import NULL_FORMAT, NUMBER_FORMATS, OTHER_FORMAT
from lavra.functions.text import REPLACEMENT_CHARACTER
from lavra.operators.aggregate import group_counts, key_coverage, row_coverage
from lavra.operators.canonical import (
    canonical_check,
    duplicate_rows,
    duplicate_summary,
)
from lavra.operators.join import (
    Reference,
    enrich_left,
    flag_matches,
    matched_keys,
    measure_keys,
    split_by_null,
    unmatched_keys,
    unmatched_rows,
)
from lavra.operators.profile import (
    char_rows,
    char_scan,
    format_examples,
    format_profile,
    key_exceptions,
    key_length_profile,
)
from lavra.operators.quality import compare_metrics, metrics
from lavra.operators.shape import preview, union_strict
from lavra.plans import contract
from lavra.plans.delivery import NAME_KEY, TAX_KEY, canonical_segments
from lavra.sources.files import (
    SourceSpec,
    charset_probe,
    detect_charset,
    first_lines,
    line_counts,
    read_delimited,
    read_lines,
    structure_probe,
)


class Report(Mapping[str, DataFrame]):
    """Named tables; each is made when it is asked for, so that one costs nothing for another."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, title: str) -> DataFrame:
        if title not in self._made:
            self._made[title] = self._makers[title]()
        return self._made[title]

    def __contains__(self, title: object) -> bool:
        return title in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


Tables = Mapping[str, DataFrame]

# Columns shown with a value that holds a replacement character.
CONTEXT_COLUMNS = [
    "ano",
    "trimestre",
    "cnpj_if",
    "cnpj",
    "instituicao_financeira",
    "nome",
    "employer_name",
    "arquivo_origem",
]


def inspect_lines(
    spark: SparkSession, specs: Sequence[SourceSpec], input_base: str, rows: int = 3
) -> Tables:
    """Lines per file (all files in one scan), and the first ones of each."""
    paths = [spec.input_path(input_base) for spec in specs]
    return {
        "lines per file": line_counts(read_lines(spark, paths)),
        **{
            f"first lines of {spec.file}": first_lines(spark, path, rows)
            for spec, path in zip(specs, paths, strict=True)
        },
    }


def inspect_structure(
    spark: SparkSession, specs: Sequence[SourceSpec], input_base: str
) -> Tables:
    """Rows, columns and names of each source as it is ingested, and its first row."""
    def first_row(spec: SourceSpec) -> DataFrame:
        path = spec.input_path(input_base)
        return preview(read_delimited(spark, path, spec.sep, spec.encoding), 1)

    return Report(
        {
            "sources as read": lambda: structure_probe(spark, specs, input_base),
            **{f"first row of {spec.file}": partial(first_row, spec) for spec in specs},
        }
    )


def inspect_charsets(
    spark: SparkSession,
    spec: SourceSpec,
    input_base: str,
    charsets: Sequence[str],
    column: str | None = None,
    values: Sequence[str] = (),
) -> Tables:
    """A source under several charsets: its shape, and its first row or chosen rows."""
    path = spec.input_path(input_base)

    def shown(charset: str) -> DataFrame:
        table = read_delimited(spark, path, spec.sep, charset)
        if column and values:
            return table.filter(F.col(column).isin(list(values))).orderBy(*table.columns)
        return preview(table, 1)

    return Report(
        {
            "charsets compared": lambda: charset_probe(spark, path, spec.sep, charsets),
            "charset that fits": lambda: detect_charset(spark, path, spec.sep).filter("best"),
            **{f"rows under {charset}": partial(shown, charset) for charset in charsets},
        }
    )


def index_profile(slices: DataFrame, column: str = "indice") -> Tables:
    """How decimals are written, and whether normalising leaves invalid ones."""
    context = [c for c in ("instituicao_financeira", contract.SOURCE_COLUMN) if c in slices.columns]
    every = [*NUMBER_FORMATS, OTHER_FORMAT]
    return {
        "notations": format_profile(slices, column).orderBy("number_format"),
        "grouped and other values": format_examples(slices, column, context=context).orderBy(
            "original", *context
        ),
        "normalised values": format_examples(slices, column, formats=every)
        .filter(F.col("number_format") != NULL_FORMAT)
        .orderBy("original"),
    }


def _usable(df: DataFrame, column: str) -> DataFrame:
    keyed = df.withColumn(TAX_KEY, fixed_width_key(F.col(column)))
    return keyed.filter(is_usable_key(F.col(TAX_KEY)))


def join_keys_profile(
    complaints: DataFrame, segments: DataFrame, reviews: DataFrame, less: DataFrame
) -> Tables:
    """Whether identifiers and names can serve as keys between the tables."""
    ids = {"complaints": (complaints, "cnpj_if"), "segments": (segments, "cnpj"), "less": (less, "cnpj")}
    lengths = [
        key_length_profile(df, column).select(F.lit(label).alias("dataset"), "*")
        for label, (df, column) in ids.items()
    ]
    exceptions = [
        key_exceptions(df, column).select(F.lit(label).alias("dataset"), "*")
        for label, (df, column) in ids.items()
    ]
    keyed = with_key_details(segments, "cnpj").filter("cnpj_chave_8 IS NOT NULL")
    detail = ["cnpj_chave_8", "segmento", "cnpj", "nome"]
    fact, reference = _usable(complaints, "cnpj_if"), _usable(segments, "cnpj")
    pair = [
        segment_key(F.col("segmento")).alias("segmento_chave"),
        weak_name_key(F.col("nome")).alias(NAME_KEY),
    ]
    pair_keys = ["segmento_chave", NAME_KEY]
    listed, reviewed = segments.select(*pair), reviews.select(*pair)
    less_keys = _usable(less, "cnpj")
    return {
        "identifier lengths": union_strict(lengths).orderBy("dataset", "n_digits"),
        "identifier exceptions": union_strict(exceptions),
        "repeated keys": duplicate_summary(keyed, ["cnpj_chave_8"]),
        "rows of repeated keys": duplicate_rows(keyed.select(*detail), ["cnpj_chave_8"]).orderBy(
            "cnpj_chave_8", "segmento", "nome", "cnpj"
        ),
        "complaint keys in segments": key_coverage(fact, reference, [TAX_KEY]),
        "complaints without segment": unmatched_rows(
            fact.select(TAX_KEY, "cnpj_if", "instituicao_financeira"), reference, [TAX_KEY]
        )
        .distinct()
        .orderBy(TAX_KEY, "cnpj_if", "instituicao_financeira"),
        "review pairs in segments": key_coverage(reviewed, listed, pair_keys),
        "review pairs without segment": unmatched_keys(reviewed, listed, pair_keys),
        "less keys in segments": key_coverage(less_keys, reference, [TAX_KEY]),
        "less keys without segment": unmatched_keys(less_keys, reference, [TAX_KEY]),
    }


def join_trial(fact: DataFrame, reference: DataFrame, key: str, attribute: str) -> Tables:
    """What a left join would do: rows before and after, rows with the attribute found."""
    joined = enrich_left(fact, reference, key, {attribute: "_attribute"})
    found = F.col("_attribute").isNotNull()
    rows = {"rows": F.count(F.lit(1))}
    outcome = {"matched": F.count_if(found), "unmatched": F.count_if(~found)}
    return {
        "outcome": metrics(joined, outcome),
        "rows kept": compare_metrics(metrics(joined, rows), metrics(fact, rows)),
    }


def strategy_profile(
    complaints: DataFrame,
    segments: DataFrame,
    reviews: DataFrame,
    sample_keys: Sequence[str] = (),
) -> Tables:
    """How far each way of enriching would reach."""
    with_id, without_id = split_by_null(complaints, "cnpj_if")
    chosen = canonical_segments(segments)
    fact = with_id.withColumn(TAX_KEY, fixed_width_key(F.col("cnpj_if")))
    trial = join_trial(fact, chosen, TAX_KEY, "nome")
    named = without_id.withColumn(NAME_KEY, strong_name_key(F.col("instituicao_financeira")))
    reviewed = reviews.withColumn(NAME_KEY, strong_name_key(F.col("nome")))
    shown = [NAME_KEY, "employer_name", "segmento", "nome", "match_percent"]
    availability = {
        "with tax id": F.count("cnpj_if"),
        "without tax id": F.count_if(F.col("cnpj_if").isNull()),
    }

    @cache
    def known() -> Reference:
        return measure_keys(reviewed, [NAME_KEY])

    def repeated() -> DataFrame:
        return duplicate_rows(reviewed.select(*shown), [NAME_KEY]).orderBy(
            F.asc(NAME_KEY), F.desc("match_percent"), F.asc("employer_name")
        )

    def rows_found() -> DataFrame:
        hits = flag_matches(named.select(NAME_KEY), known(), NAME_KEY, "hit")
        return row_coverage(hits, ["hit"])

    def picked() -> DataFrame:
        wanted = chosen.filter(F.col(TAX_KEY).isin(list(sample_keys)))
        return wanted.select(TAX_KEY, "segmento", "nome").orderBy(TAX_KEY)

    makers = {
        "tax id availability": lambda: metrics(complaints, availability),
        "types without tax id": lambda: group_counts(
            without_id, ["tipo"], [F.desc("n_rows"), F.asc("tipo")]
        ),
        "canonical segments": lambda: canonical_check(
            _usable(segments, "cnpj"), chosen, [TAX_KEY]
        ),
        "tax id join": lambda: trial["outcome"],
        "tax id join, rows kept": lambda: trial["rows kept"],
        "name keys": lambda: named.select("instituicao_financeira", NAME_KEY)
        .distinct()
        .orderBy(NAME_KEY, "instituicao_financeira"),
        "repeated review names": lambda: duplicate_summary(reviewed, [NAME_KEY]),
        "rows of repeated review names": repeated,
        "names in reviews": lambda: key_coverage(named, known().table, [NAME_KEY]),
        "rows in reviews": rows_found,
        "names found": lambda: matched_keys(named, known().table, [NAME_KEY]).orderBy(NAME_KEY),
        "names not found": lambda: unmatched_keys(named, known().table, [NAME_KEY]).orderBy(
            NAME_KEY
        ),
    }
    if sample_keys:
        makers["segments chosen"] = picked
    return Report(makers)


def replacement_profile(
    datasets: Mapping[str, DataFrame], text: str = REPLACEMENT_CHARACTER
) -> Tables:
    """Rows per text column that hold a replacement character, in all and per dataset.

    Each dataset is scanned once for the counts. ``replacement_rows`` lists the
    values of one column.
    """
    scanned = union_strict(
        [
            char_scan(df, text).select(F.lit(name).alias("dataset"), "*")
            for name, df in datasets.items()
        ]
    )
    return {
        "cells per column": scanned.filter(F.col("n_rows") > 0),
        "cells in all": scanned.agg(F.sum("n_rows").alias("n_cells")),
    }


def replacement_rows(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column that hold a replacement character, in context."""
    return char_rows(df, column, CONTEXT_COLUMNS)
