from __future__ import annotations

from collections import Counter

import fixtures
import pytest
from dataclasses import replace
from pyspark.sql import functions as F

from lavra import operators as op
from lavra import plans
from lavra.plans import contract
from lavra.plans import profiles, publish
from lavra.sources import JdbcTarget


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    """All layers built from the fixture files."""
    base = tmp_path_factory.mktemp("layers")
    counts = fixtures.write_inputs(base / "input")
    specs = [replace(s, expected_rows=counts[s.file]) for s in contract.SOURCES]
    raw = str(base / "raw")
    report = plans.ingest(spark, specs, str(base / "input"), raw)
    read = lambda spec: spark.read.parquet(spec.raw_path(raw))
    trusted = {
        "reclamacoes": plans.trusted_complaints(plans.read_complaint_slices(spark, raw)),
        "enquadramento": plans.trusted_segments(read(contract.SEGMENT_SOURCE)),
        "glassdoor_match": plans.trusted_reviews(read(contract.REVIEW_SOURCE)),
        "glassdoor_match_less": plans.trusted_reviews(
            read(contract.REVIEW_LESS_SOURCE), less=True
        ),
    }
    delivery = plans.deliver(
        trusted["reclamacoes"],
        *op.measure_references(
            plans.canonical_segments(trusted["enquadramento"]),
            plans.canonical_reviews(trusted["glassdoor_match"]),
        ),
    )
    return {
        "base": base,
        "raw": raw,
        "specs": specs,
        "counts": counts,
        "report": report,
        **trusted,
        "trusted": trusted,
        "delivery": delivery,
    }


def test_ingest_reports_every_source_and_the_total(layers):
    total = sum(layers["counts"].values())
    expected = [(f"{f}: rows stored", n, n, True) for f, n in layers["counts"].items()]
    assert rows(layers["report"]) == Counter([*expected, ("total", total, total, True)])


def test_group_ingest_is_one_job_and_gives_the_same_trusted_rows(spark, layers, tmp_path):
    specs, path = layers["specs"][:7], str(tmp_path / "group")
    folder = str(layers["base"] / "input")
    report = plans.ingest_group(
        spark, specs, contract.COMPLAINT_COLUMNS, folder, path, contract.SOURCE_COLUMN
    )
    op.enforce(report)
    assert report.count() == 3 + 7
    frame = plans.trusted_complaints(spark.read.parquet(path))
    assert rows(frame) == rows(layers["reclamacoes"])
    narrow = plans.ingest_group(
        spark, specs, contract.COMPLAINT_COLUMNS[:14], folder, path, contract.SOURCE_COLUMN
    )
    with pytest.raises(op.QualityError, match="malformed lines: found"):
        op.enforce(narrow)
    with pytest.raises(ValueError, match="share separator and charset"):
        plans.ingest_group(spark, contract.SOURCES, ["a"], folder, path, "s")


def test_raw_validation(spark, layers):
    blank = {"reclamacoes": contract.TRAILING_COLUMN}
    report = plans.validate_raw(spark, layers["specs"], layers["raw"], blank)
    op.enforce(report)
    assert report.count() == 10 + 1 + 7
    wrong = [replace(layers["specs"][0], expected_rows=1)]
    with pytest.raises(op.QualityError, match="2021_tri_01: found 10, expected 1"):
        op.enforce(plans.validate_raw(spark, wrong, layers["raw"]))


def test_trusted_complaints_schema_and_values(layers):
    frame = layers["reclamacoes"]
    assert frame.dtypes == [
        ("ano", "int"),
        ("trimestre", "int"),
        ("categoria", "string"),
        ("tipo", "string"),
        ("cnpj_if", "string"),
        ("instituicao_financeira", "string"),
        ("indice", "double"),
        *[(name, "bigint") for name in contract.COMPLAINT_COUNTS],
        ("arquivo_origem", "string"),
    ]
    first = frame.filter(F.col("arquivo_origem") == "2021_tri_01.csv")
    assert rows(first.select("cnpj_if", "indice")) == Counter(
        [
            ("12345", 16699.13),
            ("222", 54.79),
            ("333", 0.0),
            ("123456789", 12.5),
            ("0", None),
            ("999", None),
            (None, 1.5),
            (None, 2.0),
            (None, 3.0),
            (None, 4.0),
        ]
    )
    assert first.filter(F.col("instituicao_financeira") == "Grupo – Norte (Conglomerado)").count()
    total = sum(layers["counts"][s.file] for s in contract.COMPLAINT_SOURCES)
    op.enforce(op.expect(frame, plans.complaint_gates(total, 7)))


def test_slices_of_one_schema_share_a_scan(spark, layers):
    frame = plans.read_complaint_slices(spark, layers["raw"])
    assert frame._jdf.queryExecution().toString().count("FileScan") == 1


def test_slices_of_different_headers_are_united(spark, layers, tmp_path):
    raw = str(tmp_path)
    for position, spec in enumerate(contract.COMPLAINT_SOURCES):
        table = spark.read.parquet(spec.raw_path(layers["raw"]))
        if position == 2:
            table = table.withColumnRenamed("Ano", "ANO")
        table.write.parquet(spec.raw_path(raw))
    frame = plans.trusted_complaints(plans.read_complaint_slices(spark, raw))
    assert rows(frame) == rows(layers["reclamacoes"])


def test_slices_of_another_width_are_refused(spark, layers, tmp_path):
    spec = contract.COMPLAINT_SOURCES[0]
    table = spark.read.parquet(spec.raw_path(layers["raw"])).drop("_c14")
    table.write.parquet(spec.raw_path(str(tmp_path)))
    with pytest.raises(ValueError, match="columns expected"):
        plans.read_complaint_slices(spark, str(tmp_path), [spec])


def test_trusted_segments(layers):
    assert rows(layers["enquadramento"]) == Counter(
        (s.strip() or None, i if i.isdigit() else None, n or None) for s, i, n in fixtures.SEGMENTS
    )
    nulls, distinct, per_segment = plans.segment_profile(layers["enquadramento"])
    assert rows(nulls) == Counter([("segmento", 9, 1), ("cnpj", 9, 1), ("nome", 9, 1)])
    assert rows(distinct) == Counter([("segmento", 5, 6), ("cnpj", 6, 7)])
    assert rows(per_segment)[(None, 1)] == 1


def test_trusted_reviews(layers):
    match, less = layers["glassdoor_match"], layers["glassdoor_match_less"]
    assert len(match.columns) == len(less.columns) == 24
    kinds = Counter(kind for _, kind in match.dtypes)
    assert kinds == Counter({"string": 9, "bigint": 4, "double": 11})
    assert "segmento" in match.columns and "cnpj" in less.columns
    assert rows(match.select("employer_name", "reviews_count", "match_percent"))[
        ("Outro", None, None)
    ]
    assert rows(less.select("cnpj", "employer_founded", "employer_revenue")) == Counter(
        [("123450", 2003.0, None)]
    )


def test_delivery_has_its_columns_in_order(layers):
    delivery = layers["delivery"]
    assert len(delivery.columns) == contract.DELIVERY_COLUMN_COUNT
    assert delivery.columns[:2] == ["cnpj_chave", "ano"]
    assert delivery.columns[15:25] == [
        "arquivo_origem",
        "segmento_enquadramento",
        "nome_enquadramento",
        "encontrou_enquadramento",
        "encontrou_glassdoor",
        "metodo_enriquecimento",
        "chave_integracao",
        "segmento_final",
        "nome_referencia",
        "nome_chave",
    ]
    assert delivery.columns[-1] == "glassdoor_match_percent"


def test_delivery_outcomes(layers):
    first = layers["delivery"].filter(F.col("arquivo_origem") == "2021_tri_01.csv")
    found = first.select(
        "instituicao_financeira", "chave_integracao", "segmento_final", "nome_referencia",
        "encontrou_enquadramento", "encontrou_glassdoor", "glassdoor_employer_name",
    )
    assert rows(found) == Counter(
        [
            ("BANCO UM", "00012345", "S1", "UM S.A.", True, False, None),
            ("BANCO DOIS", "00000222", "S2", "DOIS - Prudencial", True, False, None),
            # A reference row without a name wins its key and then counts as not found.
            ("BANCO TRÊS", "00000333", "S3", None, False, False, None),
            ("BANCO LONGO", None, None, None, False, False, None),
            ("BANCO ZERO", "00000000", None, None, False, False, None),
            ("BANCO AUSENTE", "00000999", None, None, False, False, None),
            (
                "Açúcar S.A. (Conglomerado)", "ACUCAR S A", "S2", "Açúcar S.A.",
                False, True, "Açúcar Holding",
            ),
            (
                "Grupo – Norte (Conglomerado)", "GRUPO NORTE", "S3", "GRUPO NORTE",
                False, True, "Norte Novo",
            ),
            ("Sem Avaliação (Conglomerado)", "SEM AVALIACAO", None, None, False, False, None),
            ("---", "", None, None, False, False, None),
        ]
    )


def test_both_routes_of_the_delivery_agree(layers):
    branches = plans.deliver(
        layers["reclamacoes"],
        plans.canonical_segments(layers["enquadramento"]),
        plans.canonical_reviews(layers["glassdoor_match"]),
    )
    assert branches.columns == layers["delivery"].columns
    assert branches.dtypes == layers["delivery"].dtypes
    assert rows(branches) == rows(layers["delivery"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_delivery_of_random_rows_agrees_with_plain_python(spark, seed):
    complaints, segments, reviews = fixtures.random_tables(seed, 150)
    wanted = Counter(fixtures.expected_delivery(complaints, segments, reviews))
    fact = spark.createDataFrame(complaints, "cnpj_if string, instituicao_financeira string")
    by_id = plans.canonical_segments(
        spark.createDataFrame(segments, "segmento string, cnpj string, nome string")
    )
    by_name = plans.canonical_reviews(
        spark.createDataFrame(
            reviews,
            "segmento string, nome string, employer_name string, reviews_count long, "
            "match_percent double",
        )
    )
    added = {name: f"gd_{name}" for name in ("segmento", "nome", "employer_name")}
    shown = [
        "instituicao_financeira", "chave_integracao", "segmento_final", "nome_referencia",
        "encontrou_enquadramento", "encontrou_glassdoor", "metodo_enriquecimento",
        "gd_employer_name",
    ]
    lazily = plans.deliver(fact, by_id, by_name, added)
    measured = plans.deliver(
        fact, op.measure_reference(by_id), op.measure_reference(by_name), added
    )
    assert rows(lazily.select(*shown)) == wanted
    assert rows(measured.select(*shown)) == wanted


def test_metrics_and_gates_of_the_delivery(layers):
    delivery = layers["delivery"]
    total = delivery.count()
    counted = {tuple(r)[:3]: r["n_rows"] for r in plans.delivery_metrics(delivery).collect()}
    assert sum(counted.values()) == total
    by_id = sum(n for key, n in counted.items() if key[0] == contract.TAX_ID_METHOD)
    methods = {contract.TAX_ID_METHOD: by_id, contract.NAME_METHOD: total - by_id}
    gates = plans.delivery_gates(total, len(delivery.columns), methods)
    op.enforce(op.expect(delivery, gates))


def counted_in(table):
    """Stands in for the count a database makes."""
    return lambda session, target: table.agg(F.count("*").alias("n_rows"))


def test_final_table_and_validation_of_all_layers(spark, layers, monkeypatch):
    delivery = layers["delivery"]
    result, report = plans.materialize_final(delivery, str(layers["base"] / "final"))
    op.enforce(report)
    final = result.read(spark)
    method, found = F.col("metodo_enriquecimento"), F.col("encontrou_enquadramento")
    review = F.col("encontrou_glassdoor")
    totals = plans.Totals(
        trusted_rows={name: table.count() for name, table in layers["trusted"].items()},
        delivery_rows=result.rows,
        by_tax_id=final.filter(method == contract.TAX_ID_METHOD).count(),
        by_name=final.filter(method == contract.NAME_METHOD).count(),
        found_segment=final.filter(found).count(),
        found_review=final.filter(review).count(),
        found_neither=final.filter(~found & ~review).count(),
        replacement_rows={
            "reclamacoes.instituicao_financeira": 0,
            "enquadramento.nome": 1,
            "delivery.nome_enquadramento": 0,
        },
    )
    monkeypatch.setattr(publish, "read_jdbc", lambda session, target: final)
    monkeypatch.setattr(publish, "count_jdbc", counted_in(final))
    table = JdbcTarget("jdbc:x", "published")
    report = plans.validate_layers(layers["trusted"], delivery, table, totals)
    op.enforce(report)
    labels = {row["check"] for row in report.collect()}
    assert {"trusted total", "U+FFFD in enquadramento.nome", "published: rows"} <= labels
    with pytest.raises(op.QualityError, match="delivery rows: found .* expected 918"):
        op.enforce(plans.validate_layers(layers["trusted"], delivery))


def test_line_inspection(spark, layers):
    report = plans.inspect_lines(spark, contract.SOURCES, str(layers["base"] / "input"))
    assert rows(report["lines per file"]) == Counter(
        (file, n + 1) for file, n in layers["counts"].items()
    )
    assert report["first lines of 2021_tri_01.csv"].count() == 3


def test_structure_and_charsets(spark, layers):
    folder = str(layers["base"] / "input")
    structure = plans.inspect_structure(spark, contract.SOURCES, folder)
    shapes = rows(structure["sources as read"].select("source", "n_columns", "n_hits"))
    assert shapes[("2021_tri_01.csv", 15, 0)] and shapes[(contract.SEGMENT_SOURCE.file, 3, 1)]
    assert structure[f"first row of {contract.REVIEW_SOURCE.file}"].first()[0] == "Açúcar Ltda"
    charsets = plans.inspect_charsets(
        spark, contract.SEGMENT_SOURCE, folder, ["UTF-8", "ISO-8859-1"], "CNPJ", ["777"]
    )
    assert rows(charsets["charsets compared"].select("source", "n_hits")) == Counter(
        [("UTF-8", 1), ("ISO-8859-1", 0)]
    )
    assert charsets["rows under UTF-8"].first()["Nome"] == "SOBRA CR�DITO"
    assert charsets["rows under ISO-8859-1"].first()["Nome"] == "SOBRA CRï¿½DITO"


def test_index_profile(spark, layers):
    first = plans.read_complaint_slices(spark, layers["raw"], contract.COMPLAINT_SOURCES[:1])
    report = plans.index_profile(first)
    assert rows(report["notations"]) == Counter(
        [
            ("NULO", 2, 0),
            ("MILHAR_PONTO_DECIMAL_VIRGULA", 1, 0),
            ("DECIMAL_VIRGULA", 2, 0),
            ("DECIMAL_PONTO", 1, 0),
            ("INTEIRO", 4, 0),
        ]
    )
    assert rows(report["grouped and other values"]) == Counter(
        [
            (
                "16.699,13", "MILHAR_PONTO_DECIMAL_VIRGULA", "16699.13", "BANCO UM",
                "2021_tri_01.csv",
            )
        ]
    )
    assert report["normalised values"].count() == 8


def test_join_keys_profile(layers):
    first = layers["reclamacoes"].filter(F.col("arquivo_origem") == "2021_tri_01.csv")
    report = plans.join_keys_profile(
        first, layers["enquadramento"], layers["glassdoor_match"], layers["glassdoor_match_less"]
    )
    lengths = rows(report["identifier lengths"])
    assert lengths[("complaints", None, 4)] and lengths[("complaints", 9, 1)]
    assert rows(report["identifier exceptions"]) == Counter(
        [("complaints", 1, 1), ("segments", 1, 1), ("less", 0, 0)]
    )
    assert report["repeated keys"].first() == (2, 4)
    assert report["rows of repeated keys"].count() == 4
    assert tuple(report["complaint keys in segments"].first()) == (4, 3, 1, 75.0)
    assert rows(report["complaints without segment"]) == Counter(
        [("00000999", "999", "BANCO AUSENTE")]
    )
    assert tuple(report["review pairs in segments"].first())[:3] == (4, 0, 4)
    assert report["review pairs without segment"].count() == 4
    assert tuple(report["less keys in segments"].first())[:3] == (1, 0, 1)
    assert rows(report["less keys without segment"]) == Counter([("00123450",)])


def test_strategy_profile(layers):
    first = layers["reclamacoes"].filter(F.col("arquivo_origem") == "2021_tri_01.csv")
    report = plans.strategy_profile(
        first, layers["enquadramento"], layers["glassdoor_match"], ["00012345", "00000777"]
    )
    assert rows(report["tax id availability"]) == Counter(
        [("with tax id", 6), ("without tax id", 4)]
    )
    assert rows(report["types without tax id"]) == Counter([("Banco", 4)])
    assert report["canonical segments"].first() == (4, 4, 0)
    assert rows(report["tax id join"]) == Counter([("matched", 2), ("unmatched", 4)])
    assert rows(report["tax id join, rows kept"]) == Counter([("rows", 6, 6, True)])
    assert report["name keys"].count() == 4
    assert report["repeated review names"].first() == (2, 4)
    repeated = [r["employer_name"] for r in report["rows of repeated review names"].collect()]
    assert repeated[2:] == ["Norte Novo", "Norte Velho"]
    assert tuple(report["names in reviews"].first()) == (4, 2, 2, 50.0)
    assert tuple(report["rows in reviews"].first()) == (4, 2, 2, 50.0)
    assert rows(report["names found"]) == Counter([("ACUCAR S A",), ("GRUPO NORTE",)])
    assert rows(report["names not found"]) == Counter([("",), ("SEM AVALIACAO",)])
    assert rows(report["segments chosen"]) == Counter(
        [("00012345", "S1", "UM S.A."), ("00000777", "S5", "SOBRA CR�DITO")]
    )


def test_join_trial_shows_a_reference_that_is_not_unique(spark):
    fact = spark.createDataFrame([("a",), ("b",)], "k string")
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "k string, v string")
    trial = plans.join_trial(fact, twice, "k", "v")
    assert rows(trial["rows kept"]) == Counter([("rows", 3, 2, False)])


def test_replacement_profile(layers):
    report = plans.replacement_profile({**layers["trusted"], "delivery": layers["delivery"]})
    assert rows(report["cells per column"]) == Counter([("enquadramento", "nome", 1)])
    assert report["cells in all"].first() == (1,)
    listed = plans.replacement_rows(layers["enquadramento"], "nome")
    assert rows(listed) == Counter([("777", "SOBRA CR�DITO")])


def test_jdbc_round_trip_checks_count_and_content(spark, monkeypatch):
    """The relational store is stood in for by a table; no database is started."""
    kept = {}
    monkeypatch.setattr(publish, "write_jdbc", lambda df, target, **o: kept.update(df=df))
    monkeypatch.setattr(publish, "read_jdbc", lambda session, target: kept["df"])
    target = JdbcTarget("jdbc:x", "probe")
    op.enforce(plans.jdbc_round_trip(spark, target))
    monkeypatch.setattr(
        publish, "read_jdbc", lambda s, t: kept["df"].withColumn("status", F.lit("no"))
    )
    with pytest.raises(op.QualityError, match="rows as written: found 0, expected 1"):
        op.enforce(plans.jdbc_round_trip(spark, target))


def test_publishing_compares_rows_and_column_names(spark, monkeypatch):
    """The relational store is stood in for by a table; no database is started."""
    source = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    stored = source.drop("s").withColumn("x", F.lit(1))
    written = {}
    monkeypatch.setattr(publish, "write_jdbc", lambda df, target, **o: written.update(o))
    monkeypatch.setattr(publish, "read_jdbc", lambda session, target: stored)
    monkeypatch.setattr(publish, "count_jdbc", counted_in(stored))
    report = plans.publish_table(source, 2, JdbcTarget("jdbc:x", "t"), truncate=True)
    assert written == {"truncate": True}
    assert rows(report) == Counter(
        [
            ("t: rows", 2, 2, True),
            ("t: columns missing", 1, 0, False),
            ("t: columns extra", 1, 0, False),
        ]
    )


def test_reports_are_made_when_asked_for(spark, layers, monkeypatch):
    made = []
    real = profiles.measure_keys
    monkeypatch.setattr(profiles, "measure_keys", lambda *a: made.append(a) or real(*a))
    report = plans.strategy_profile(
        layers["reclamacoes"], layers["enquadramento"], layers["glassdoor_match"]
    )
    assert len(report) == 12 and "names found" in report
    report["rows of repeated review names"].collect()
    assert not made
    assert report["names found"] is report["names found"]
    report["names not found"].collect()
    assert len(made) == 1  # the keys are measured once for all tables that need them
    with pytest.raises(KeyError):
        report["unknown"]


def test_the_fitting_charset_is_named(spark, layers):
    folder = str(layers["base"] / "input")
    report = plans.inspect_charsets(spark, contract.COMPLAINT_SOURCES[0], folder, ["UTF-8"])
    assert report["charset that fits"].first()["charset"] in ("ISO-8859-1", "windows-1252")
