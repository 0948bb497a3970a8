"""The steps of the complaint data set as jobs, one per name.

    spark-submit run_job.py STEP --base FOLDER [--free-totals] [--jdbc-url URL ...]

The folder holds ``input``; the steps add ``raw``, ``trusted`` and ``delivery``.
Reports are shown; a failed gate ends the job with an error. Trusted tables, the delivery and
the final table are kept in versions: a new one is published once all gates are passed, until
then the old one is read. Lines and rows that do not fit are stored as rejects, and fail the
job unless ``--allow-rejects`` is given.
With ``--free-totals`` each layer is compared with the one before instead of the totals
of the original files.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra import plans
from lavra.operators import (
    Gate,
    columns_of_type,
    distinct_counts,
    enforce,
    expect,
    measure_references,
    stack_reports,
)
from lavra.plans import contract
from lavra.session import build_session
from lavra.sources import (
    JdbcTarget,
    VersionedTable,
    file_manifest,
    jdbc_shape,
    publish_all,
    read_jdbc,
)

TRUSTED_FOLDERS = {
    "reclamacoes": "reclamacoes",
    "enquadramento": "enquadramento",
    "glassdoor_match": "glassdoor/match",
    "glassdoor_match_less": "glassdoor/match_less",
}


@dataclass(frozen=True)
class Context:
    """Where the layers lie and what the run may require of them."""

    spark: SparkSession
    base: str
    check_totals: bool = True
    jdbc: JdbcTarget | None = None
    show_rows: int = 100
    keys: Sequence[str] = ()
    years: Sequence[int] = ()
    jdbc_options: dict = field(default_factory=dict)
    allow_rejects: bool = False

    @property
    def input(self) -> str:
        return f"{self.base}/input"

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def rejected_lines(self) -> str:
        return f"{self.base}/rejects/raw"

    @property
    def delivery(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.base}/delivery/reclamacoes_enriquecidas")

    @property
    def final(self) -> str:
        return f"{self.base}/delivery/tabela_final_reclamacoes"

    def trusted_table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.base}/trusted/{TRUSTED_FOLDERS[name]}")

    def trusted(self, name: str) -> DataFrame:
        return self.trusted_table(name).read()

    def rejects_table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.base}/rejects/{TRUSTED_FOLDERS[name]}")

    def table(self, name: str) -> JdbcTarget:
        if self.jdbc is None:
            raise ValueError("this step needs --jdbc-url")
        return replace(self.jdbc, table=self.jdbc.table or name)

    def show(self, title: str, df: DataFrame) -> None:
        print(f"\n{title}")
        df.show(self.show_rows, truncate=False)

    def show_all(self, reports: Mapping[str, DataFrame]) -> None:
        for title, df in reports.items():
            self.show(title, df)

    def pass_gates(self, title: str, report: DataFrame) -> None:
        """Show a report and enforce it; it is worked out once (one row per check)."""
        rows = self.spark.createDataFrame(report.collect(), report.schema)
        self.show(title, rows)
        enforce(rows)


def inspect(c: Context) -> None:
    c.show_all(plans.inspect_lines(c.spark, contract.SOURCES, c.input))


def manifest(c: Context) -> None:
    c.show("files", file_manifest(c.spark, c.input).orderBy("file"))


def structure(c: Context) -> None:
    c.show_all(plans.inspect_structure(c.spark, contract.SOURCES, c.input))


def charsets(c: Context) -> None:
    charsets = ["UTF-8", "ISO-8859-1", "windows-1252"]
    first, segments = contract.COMPLAINT_SOURCES[0], contract.SEGMENT_SOURCE
    c.show_all(plans.inspect_charsets(c.spark, first, c.input, charsets))
    c.show_all(plans.inspect_charsets(c.spark, segments, c.input, charsets, "CNPJ", c.keys))


def ingest(c: Context) -> None:
    report = plans.ingest(c.spark, contract.SOURCES, c.input, c.raw, rejects=c.rejected_lines)
    if c.allow_rejects:
        layout = F.col("check").endswith(": malformed lines")
        report = report.withColumns(
            {
                "expected": F.when(~layout, F.col("expected")),
                "ok": F.when(~layout, F.col("ok")),
            }
        )
        c.show("malformed lines", plans.read_rejects(c.spark, contract.SOURCES, c.rejected_lines))
    c.pass_gates("rows stored per source", report)


def validate_raw(c: Context) -> None:
    blank = {"reclamacoes": contract.TRAILING_COLUMN}
    specs = contract.SOURCES
    if not c.check_totals:
        specs = [replace(spec, expected_rows=None) for spec in specs]
    c.pass_gates("raw layer", plans.validate_raw(c.spark, specs, c.raw, blank))


def index(c: Context) -> None:
    c.show_all(plans.index_profile(plans.read_complaint_slices(c.spark, c.raw)))


def trusted(c: Context) -> None:
    def raw(spec):
        return c.spark.read.parquet(spec.raw_path(c.raw))

    parts = {
        "reclamacoes": plans.quarantined_complaints(plans.read_complaint_slices(c.spark, c.raw)),
        "glassdoor_match": plans.quarantined_reviews(raw(contract.REVIEW_SOURCE)),
        "glassdoor_match_less": plans.quarantined_reviews(
            raw(contract.REVIEW_LESS_SOURCE), less=True
        ),
    }
    tables = {name: part.good for name, part in parts.items()}
    tables["enquadramento"] = plans.trusted_segments(raw(contract.SEGMENT_SOURCE))
    totals = plans.Totals().trusted_rows
    reports, versions = [], []
    for name, part in parts.items():
        rows = part.rows + part.rejected_rows
        allowed = None if c.allow_rejects else 0
        reports.append(expect(part.good, part.gates(rows, name, allowed)))
        if part.rejected_rows:
            c.show(f"rejects of {name}", part.rejects)
        # Rejects are published whatever the gates say: they are what is to be looked at.
        c.rejects_table(name).replace(part.rejects, f"rejects of {name}")
    for name, df in tables.items():
        table = c.trusted_table(name)
        version, result, report = table.write(df, name, content=True)
        versions.append((table, version))
        reports.append(report)
        wanted = totals[name] if c.check_totals else result.rows
        gates = {f"rows of {name}": Gate(F.count(F.lit(1)), wanted)}
        if name == "reclamacoes":
            years = contract.COMPLAINT_YEARS if c.check_totals else c.years
            gates = plans.complaint_gates(wanted, len(contract.COMPLAINT_SOURCES), years)
            if not years:
                del gates["years outside domain"]
        reports.append(expect(result.read(c.spark), gates))
    c.pass_gates("trusted layer", stack_reports(reports))
    publish_all(versions)
    nulls, distinct, per_segment = plans.segment_profile(c.trusted("enquadramento"))
    c.show_all({"nulls": nulls, "distinct values": distinct, "rows per segment": per_segment})


def join_keys(c: Context) -> None:
    c.show_all(plans.join_keys_profile(*[c.trusted(name) for name in TRUSTED_FOLDERS]))


def strategy(c: Context) -> None:
    tables = [c.trusted(name) for name in list(TRUSTED_FOLDERS)[:3]]
    c.show_all(plans.strategy_profile(*tables, sample_keys=c.keys))


def deliver(c: Context) -> None:
    segments, reviews = measure_references(
        plans.canonical_segments(c.trusted("enquadramento")),
        plans.canonical_reviews(c.trusted("glassdoor_match")),
        on=[plans.TAX_KEY, plans.NAME_KEY],
    )
    complaints = c.trusted("reclamacoes")
    delivery = plans.deliver(complaints, segments, reviews)
    version, result, stored = c.delivery.write(delivery, "delivery", content=True)
    totals = plans.Totals()
    methods = {
        contract.TAX_ID_METHOD: totals.by_tax_id,
        contract.NAME_METHOD: totals.by_name,
    }
    gates = plans.delivery_gates(
        totals.delivery_rows if c.check_totals else result.rows,
        result.columns,
        methods if c.check_totals else None,
    )
    kept = expect(complaints, {"complaints kept": Gate(F.count(F.lit(1)), result.rows)})
    written = result.read(c.spark)
    unique = [segments.key_gates("one segment per key"), reviews.key_gates("one review per key")]
    c.pass_gates("delivery", stack_reports([*unique, stored, kept, expect(written, gates)]))
    c.delivery.publish(version)
    c.show("rows per method", plans.delivery_metrics(c.delivery.read()))


def check_jdbc(c: Context) -> None:
    c.pass_gates("round trip", plans.jdbc_round_trip(c.spark, c.table("lavra_probe")))


def publish(c: Context) -> None:
    delivery = c.delivery.read()
    target = c.table(contract.DELIVERY_TABLE)
    report = plans.publish_table(delivery, delivery.count(), target, **c.jdbc_options)
    c.pass_gates("published delivery", report)
    c.show("rows per method", plans.delivery_metrics(read_jdbc(c.spark, target)))


def final(c: Context) -> None:
    delivery = c.delivery.read()
    target = c.table(contract.FINAL_TABLE) if c.jdbc else None
    _, report = plans.materialize_final(delivery, c.final, target, **c.jdbc_options)
    c.pass_gates("final table", report)
    if target:
        c.show("as the database sees it", jdbc_shape(c.spark, target))


def characters(c: Context) -> None:
    tables = {name: c.trusted(name) for name in TRUSTED_FOLDERS}
    tables["delivery"] = c.delivery.read()
    profile = plans.replacement_profile(tables)
    c.show_all(profile)
    # One row per text column of the schemas: their number does not grow with the data.
    for row in profile["cells per column"].collect():
        table = tables[row["dataset"]]
        title = f"{row['dataset']}.{row['column']}"
        c.show(title, plans.replacement_rows(table, row["column"]))


def validate(c: Context) -> None:
    tables = {name: c.trusted(name) for name in TRUSTED_FOLDERS}
    delivery = c.delivery.read()
    published = c.table(contract.DELIVERY_TABLE) if c.jdbc else None
    totals = plans.Totals()
    if not c.check_totals:
        sources = {
            "reclamacoes": contract.COMPLAINT_SOURCES,
            "enquadramento": [contract.SEGMENT_SOURCE],
            "glassdoor_match": [contract.REVIEW_SOURCE],
            "glassdoor_match_less": [contract.REVIEW_LESS_SOURCE],
        }
        raw = {
            name: sum(c.spark.read.parquet(spec.raw_path(c.raw)).count() for spec in specs)
            for name, specs in sources.items()
        }
        totals = plans.totals_from(tables, raw)
    c.pass_gates("all layers", plans.validate_layers(tables, delivery, published, totals))
    texts = columns_of_type(delivery)
    c.show("distinct values of the delivery", distinct_counts(delivery, texts))
    c.show("rows per method", plans.delivery_metrics(delivery))


STEPS: dict[str, Callable[[Context], None]] = {
    "inspect": inspect,
    "manifest": manifest,
    "structure": structure,
    "charsets": charsets,
    "ingest": ingest,
    "validate-raw": validate_raw,
    "index": index,
    "trusted": trusted,
    "join-keys": join_keys,
    "strategy": strategy,
    "deliver": deliver,
    "check-jdbc": check_jdbc,
    "publish": publish,
    "final": final,
    "characters": characters,
    "validate": validate,
}


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Steps of the complaint data set")
    parser.add_argument("step", choices=list(STEPS))
    parser.add_argument("--base", required=True, help="folder of the layers")
    parser.add_argument("--free-totals", action="store_true")
    parser.add_argument("--allow-rejects", action="store_true")
    parser.add_argument("--show-rows", type=int, default=100)
    parser.add_argument("--keys", nargs="*", default=[], help="keys to show in 'strategy'")
    parser.add_argument("--years", nargs="*", type=int, default=[], help="years that may occur")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-table", default="")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE")
    parser.add_argument("--jdbc-connections", type=int, default=16)
    parser.add_argument("--jdbc-truncate", action="store_true")
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    options = parse(arguments)
    jdbc = None
    if options.jdbc_url:
        properties = dict(item.split("=", 1) for item in options.jdbc_property)
        jdbc = JdbcTarget(options.jdbc_url, options.jdbc_table, properties)
    context = Context(
        spark or build_session(f"lavra {options.step}"),
        options.base.rstrip("/"),
        not options.free_totals,
        jdbc,
        options.show_rows,
        options.keys,
        options.years,
        {"connections": options.jdbc_connections, "truncate": options.jdbc_truncate},
        options.allow_rejects,
    )
    STEPS[options.step](context)
