"""Validation of all layers against known totals, as one report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.functions.text import REPLACEMENT_CHARACTER, contains_char
from lavra.operators.quality import Gate, expect, stack_reports
from lavra.plans import contract
from lavra.plans.ingest import with_total
from lavra.plans.publish import published_gates
from lavra.sources.jdbc import JdbcTarget


@dataclass(frozen=True)
class Totals:
    """What the layers should hold; None is not checked.

    The defaults are fixed values of the original data.
    """

    trusted_rows: Mapping[str, int | None] = field(
        default_factory=lambda: {
            "reclamacoes": 918,
            "enquadramento": 1474,
            "glassdoor_match": 34,
            "glassdoor_match_less": 5,
        }
    )
    delivery_rows: int | None = 918
    delivery_columns: int = contract.DELIVERY_COLUMN_COUNT
    by_tax_id: int | None = 437
    by_name: int | None = 481
    found_segment: int | None = 321
    found_review: int | None = 113
    found_neither: int | None = 484
    replacement_rows: Mapping[str, int | None] = field(
        default_factory=lambda: {
            "reclamacoes.instituicao_financeira": 0,
            "enquadramento.nome": 950,
            "glassdoor_match.nome": 0,
            "glassdoor_match_less.nome": 0,
            "delivery.nome_enquadramento": 10,
            "delivery.nome_referencia": 10,
        }
    )


def totals_from(
    trusted: Mapping[str, DataFrame], earlier_rows: Mapping[str, int | None]
) -> Totals:
    """Totals for any data: each layer has to hold what the layer before holds.

    ``earlier_rows`` are the rows that the trusted tables were made from. Complaints with a
    tax id take one branch of the delivery, the others the other one. How many rows find a
    reference, or hold U+FFFD, follows from no earlier count and is not checked.
    """
    complaints = trusted["reclamacoes"].agg(
        F.count(F.lit(1)).alias("n"), F.count("cnpj_if").alias("with_id")
    )
    row = complaints.first()
    return Totals(
        trusted_rows=earlier_rows,
        delivery_rows=row["n"],
        by_tax_id=row["with_id"],
        by_name=row["n"] - row["with_id"],
        found_segment=None,
        found_review=None,
        found_neither=None,
        replacement_rows=dict.fromkeys(Totals().replacement_rows),
    )


def _replacement_gates(table: str, totals: Totals) -> dict[str, Gate]:
    gates = {}
    for label, expected in totals.replacement_rows.items():
        owner, column = label.split(".")
        if owner == table:
            hit = contains_char(F.col(column), REPLACEMENT_CHARACTER)
            gates[f"U+FFFD in {label}"] = Gate(F.count_if(hit), expected)
    return gates


def validate_layers(
    trusted: Mapping[str, DataFrame],
    delivery: DataFrame,
    published: JdbcTarget | None = None,
    totals: Totals | None = None,
) -> DataFrame:
    """All gates on the trusted tables, the delivery and its published copy.

    Row counts come from Parquet footers; the text checks of a table share one pass
    over the columns concerned, and so do all checks on the delivery.
    """
    totals = totals or Totals()
    counts, texts = [], []
    for name, table in trusted.items():
        rows = {f"rows of {name}": Gate(F.count(F.lit(1)), totals.trusted_rows[name])}
        counts.append(expect(table, rows))
        replaced = _replacement_gates(name, totals)
        if replaced:
            texts.append(expect(table, replaced))
    segment, review = F.col("encontrou_enquadramento"), F.col("encontrou_glassdoor")
    method = F.col("metodo_enriquecimento")
    strays = contains_char(F.col("nome_enquadramento"), REPLACEMENT_CHARACTER) & (
        method != contract.TAX_ID_METHOD
    )
    delivery_gates = {
        "delivery rows": Gate(F.count(F.lit(1)), totals.delivery_rows),
        "delivery columns": Gate(F.max(F.lit(len(delivery.columns))), totals.delivery_columns),
        contract.TAX_ID_METHOD: Gate(F.count_if(method == contract.TAX_ID_METHOD), totals.by_tax_id),
        contract.NAME_METHOD: Gate(F.count_if(method == contract.NAME_METHOD), totals.by_name),
        "rows with segment": Gate(F.count_if(segment), totals.found_segment),
        "rows with review": Gate(F.count_if(review), totals.found_review),
        "rows with neither": Gate(F.count_if(~segment & ~review), totals.found_neither),
        **_replacement_gates("delivery", totals),
        "U+FFFD outside the tax id branch": Gate(F.count_if(strays), 0),
    }
    reports = [
        with_total(stack_reports(counts), "trusted total"),
        *texts,
        expect(delivery, delivery_gates),
    ]
    if published is not None:
        reports.append(published_gates(delivery, totals.delivery_rows, published))
    return stack_reports(reports)
