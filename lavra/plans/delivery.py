"""Delivery layer: every complaint, enriched by tax id or else by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.keys import (
    fixed_width_key,
    is_usable_key,
    priority_rank,
    strong_name_key,
)
from lavra.operators.aggregate import group_counts
from lavra.operators.canonical import canonical
from lavra.operators.join import Reference, enrich_left, split_by_null
from lavra.operators.quality import Gate, expect
from lavra.operators.shape import union_filled
from lavra.plans import contract

TAX_KEY = "cnpj_chave"
NAME_KEY = "nome_chave"
_KIND = "_by_tax_id"
_VALUE = "_key"

# What each branch adds after its join, in column order.
_OUTCOME = [
    "encontrou_enquadramento",
    "encontrou_glassdoor",
    "metodo_enriquecimento",
    "chave_integracao",
    "segmento_final",
    "nome_referencia",
]


def canonical_segments(segments: DataFrame) -> DataFrame:
    """One segment row per usable tax key: unmarked names first, then by name."""
    keyed = segments.withColumn(TAX_KEY, fixed_width_key(F.col("cnpj")))
    return canonical(
        keyed.filter(is_usable_key(F.col(TAX_KEY))),
        [TAX_KEY],
        [priority_rank(F.col("nome")).asc(), F.col("nome").asc_nulls_first()],
        tie_break=[name for name in segments.columns if name != "nome"],
    )


def canonical_reviews(reviews: DataFrame) -> DataFrame:
    """One review row per name: best match, then most reviews, then employer name."""
    ranked = ("match_percent", "reviews_count", "employer_name")
    return canonical(
        reviews.withColumn(NAME_KEY, strong_name_key(F.col("nome"))),
        [NAME_KEY],
        [
            F.col("match_percent").desc_nulls_last(),
            F.col("reviews_count").desc_nulls_last(),
            F.col("employer_name").asc_nulls_first(),
        ],
        tie_break=[name for name in reviews.columns if name not in ranked],
    )


def deliver(
    complaints: DataFrame,
    segments: DataFrame | Reference,
    reviews: DataFrame | Reference,
    review_columns: dict[str, str] | None = None,
    tax_id: str = "cnpj_if",
    name: str = "instituicao_financeira",
) -> DataFrame:
    """Join each complaint with its canonical reference row; no row is lost or added.

    With both references measured and small, the complaints are read once and both
    lookups are made on the way. Otherwise both references are put into one, told apart by the
    kind of key, so that the complaints are read once and shuffled once.
    """
    added = contract.REVIEW_ENRICHMENT if review_columns is None else review_columns
    measured = [r for r in (segments, reviews) if isinstance(r, Reference)]
    if len(measured) == 2 and all(reference.fits_broadcast() for reference in measured):
        return _single_pass(complaints, segments, reviews, added, tax_id, name)
    return deliver_in_one_shuffle(complaints, segments, reviews, review_columns, tax_id, name)


def deliver_in_one_shuffle(
    complaints: DataFrame,
    segments: DataFrame | Reference,
    reviews: DataFrame | Reference,
    review_columns: dict[str, str] | None = None,
    tax_id: str = "cnpj_if",
    name: str = "instituicao_financeira",
) -> DataFrame:
    """The delivery by one join on a tagged key: its kind and its value.

    Each complaint looks up one key, its tax id or else its name, so one table of both
    references serves all. A tax id of one kind never meets an equal name of the other.
    Complaints whose tax id makes no key are spread, not gathered (see ``enrich_left``).
    """
    added = contract.REVIEW_ENRICHMENT if review_columns is None else review_columns
    by_tax_id = F.col(tax_id).isNotNull()
    keyed = complaints.withColumns(
        {
            TAX_KEY: F.when(by_tax_id, fixed_width_key(F.col(tax_id))),
            NAME_KEY: F.when(~by_tax_id, strong_name_key(F.col(name))),
        }
    ).withColumns({_KIND: by_tax_id, _VALUE: F.coalesce(TAX_KEY, NAME_KEY)})

    def tagged(reference, key: str, is_tax_id: bool, columns: dict[str, str]) -> DataFrame:
        if isinstance(reference, Reference):
            reference.require_unique([key])
            reference = reference.table
        values = [F.col(source).alias(target) for source, target in columns.items()]
        return reference.filter(F.col(key).isNotNull()).select(
            F.lit(is_tax_id).alias(_KIND), F.col(key).alias(_VALUE), *values
        )

    both = union_filled(
        [
            tagged(segments, TAX_KEY, True, contract.SEGMENT_ENRICHMENT),
            tagged(reviews, NAME_KEY, False, added),
        ]
    )
    columns = [*contract.SEGMENT_ENRICHMENT.values(), *added.values()]
    joined = enrich_left(keyed, both, [_KIND, _VALUE], {c: c for c in columns})
    return _with_outcome(joined, added, tax_id).select(
        *_delivery_order(complaints, added)
    )


def deliver_by_branch(
    complaints: DataFrame,
    segments: DataFrame | Reference,
    reviews: DataFrame | Reference,
    review_columns: dict[str, str] | None = None,
    tax_id: str = "cnpj_if",
    name: str = "instituicao_financeira",
) -> DataFrame:
    """The delivery by two joins, united with null-fill: complaints with and without a tax id.

    Reads the complaints twice; ``deliver`` does not take this way.
    """
    added = contract.REVIEW_ENRICHMENT if review_columns is None else review_columns
    return _two_branches(complaints, segments, reviews, added, tax_id, name)


def _single_pass(complaints, segments, reviews, added, tax_id, name) -> DataFrame:
    by_tax_id = F.col(tax_id).isNotNull()
    keyed = complaints.withColumns(
        {
            TAX_KEY: F.when(by_tax_id, fixed_width_key(F.col(tax_id))),
            NAME_KEY: F.when(~by_tax_id, strong_name_key(F.col(name))),
        }
    )
    joined = enrich_left(
        enrich_left(keyed, segments, TAX_KEY, contract.SEGMENT_ENRICHMENT),
        reviews,
        NAME_KEY,
        added,
    )
    return _with_outcome(joined, added, tax_id).select(
        *_delivery_order(complaints, added)
    )


def _with_outcome(joined: DataFrame, added: dict[str, str], tax_id: str) -> DataFrame:
    by_tax_id = F.col(tax_id).isNotNull()
    outcome = {
        "encontrou_enquadramento": F.col("nome_enquadramento").isNotNull(),
        "encontrou_glassdoor": F.col(added["employer_name"]).isNotNull(),
        "metodo_enriquecimento": F.when(by_tax_id, contract.TAX_ID_METHOD).otherwise(
            contract.NAME_METHOD
        ),
        "chave_integracao": F.when(by_tax_id, F.col(TAX_KEY)).otherwise(F.col(NAME_KEY)),
        "segmento_final": F.when(by_tax_id, F.col("segmento_enquadramento")).otherwise(
            F.col(added["segmento"])
        ),
        "nome_referencia": F.when(by_tax_id, F.col("nome_enquadramento")).otherwise(
            F.col(added["nome"])
        ),
    }
    return joined.withColumns(outcome)


def _delivery_order(complaints: DataFrame, added: dict[str, str]) -> list[str]:
    return [
        TAX_KEY,
        *complaints.columns,
        *contract.SEGMENT_ENRICHMENT.values(),
        *_OUTCOME,
        NAME_KEY,
        *added.values(),
    ]


def _two_branches(complaints, segments, reviews, added, tax_id, name) -> DataFrame:
    with_id, without_id = split_by_null(complaints, tax_id)

    def outcome(by_tax_id: bool, key: str, found: str, segment: str, title: str) -> dict:
        method = contract.TAX_ID_METHOD if by_tax_id else contract.NAME_METHOD
        hit = F.col(found).isNotNull()
        columns = [
            hit if by_tax_id else F.lit(False),
            F.lit(False) if by_tax_id else hit,
            F.lit(method),
            F.col(key),
            F.col(segment),
            F.col(title),
        ]
        return dict(zip(_OUTCOME, columns, strict=True))

    tax_branch = enrich_left(
        with_id.withColumn(TAX_KEY, fixed_width_key(F.col(tax_id))),
        segments,
        TAX_KEY,
        contract.SEGMENT_ENRICHMENT,
    ).withColumns(
        outcome(
            True, TAX_KEY, "nome_enquadramento", "segmento_enquadramento", "nome_enquadramento"
        )
    )
    name_branch = enrich_left(
        without_id.withColumn(NAME_KEY, strong_name_key(F.col(name))), reviews, NAME_KEY, added
    ).withColumns(
        outcome(False, NAME_KEY, added["employer_name"], added["segmento"], added["nome"])
    )
    return union_filled([tax_branch, name_branch])


def unique_keys(reference: DataFrame, key: str, label: str) -> DataFrame:
    """Report: a reference holds as many rows with a key as it has keys."""
    keys = reference.filter(F.col(key).isNotNull()).groupBy(key).count()
    return expect(keys, {label: Gate(F.count_if(F.col("count") > 1), 0)})


def delivery_gates(
    rows: int, columns: int | None = None, methods: dict[str, int] | None = None
) -> dict[str, Gate]:
    """Gates on the delivery, all answered by one pass: rows, columns, rows per method."""
    gates = {"delivery rows": Gate(F.count(F.lit(1)), rows)}
    if columns is not None:
        gates["delivery columns"] = Gate(F.max(F.lit(columns)), contract.DELIVERY_COLUMN_COUNT)
    for method, expected in (methods or {}).items():
        in_method = F.col("metodo_enriquecimento") == method
        gates[f"rows by {method}"] = Gate(F.count_if(in_method), expected)
    return gates


def delivery_metrics(delivery: DataFrame) -> DataFrame:
    """Rows per method and pair of match flags."""
    keys = ["metodo_enriquecimento", "encontrou_enquadramento", "encontrou_glassdoor"]
    return group_counts(delivery, keys, keys)
