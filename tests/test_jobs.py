from __future__ import annotations

import fixtures
import pytest

from lavra import jobs
from lavra.operators import QualityError
from lavra.plans import contract
from lavra.sources import VersionedTable

# The steps that need a database are covered with stand-ins in test_plans.
IN_ORDER = [name for name in jobs.STEPS if name not in ("check-jdbc", "publish")]


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    fixtures.write_inputs(folder / "input")
    return str(folder)


@pytest.mark.parametrize("step", IN_ORDER)
def test_steps_run_one_after_another(spark, base, capsys, step):
    jobs.main([step, "--base", base, "--free-totals", "--keys", "00012345"], spark)
    assert "+--" in capsys.readouterr().out


def test_layers_lie_where_they_belong(spark, base):
    final = VersionedTable(spark, f"{base}/delivery/tabela_final_reclamacoes").read()
    assert len(final.columns) == contract.DELIVERY_COLUMN_COUNT
    assert spark.read.parquet(f"{base}/raw/glassdoor/match").count() == len(fixtures.REVIEWS)
    trusted = VersionedTable(spark, f"{base}/trusted/glassdoor/match_less")
    assert len(trusted.read().columns) == 24
    assert VersionedTable(spark, f"{base}/rejects/glassdoor/match").read().isEmpty()


@pytest.mark.parametrize("step", ["validate-raw", "trusted", "deliver", "validate"])
def test_other_totals_are_refused(spark, base, step):
    with pytest.raises(QualityError, match="expected"):
        jobs.main([step, "--base", base], spark)


def test_a_database_step_needs_an_address(spark, base):
    with pytest.raises(ValueError, match="--jdbc-url"):
        jobs.main(["check-jdbc", "--base", base], spark)


def test_a_failed_run_leaves_the_published_tables(spark, base):
    table = VersionedTable(spark, f"{base}/trusted/reclamacoes")
    before = table.log()
    with pytest.raises(QualityError):
        jobs.main(["trusted", "--base", base], spark)
    assert table.log() == before and table.read().count() > 0


def test_rejects_fail_the_job_unless_they_are_allowed(spark, tmp_path, capsys):
    base = str(tmp_path)
    fixtures.write_inputs(tmp_path / "input")
    spec = contract.REVIEW_SOURCE
    path = tmp_path / "input" / spec.file
    lines = path.read_text(spec.encoding).splitlines()
    spoilt = lines[1].split(spec.sep)
    spoilt[1] = "many"  # reviews_count
    path.write_text("\n".join([*lines, spec.sep.join(spoilt), lines[1] + spec.sep + "x"]) + "\n", spec.encoding)
    with pytest.raises(QualityError, match="malformed lines: found 1"):
        jobs.main(["ingest", "--base", base, "--free-totals"], spark)
    jobs.main(["ingest", "--base", base, "--free-totals", "--allow-rejects"], spark)
    with pytest.raises(QualityError, match="glassdoor_match: rejected rows: found 1"):
        jobs.main(["trusted", "--base", base, "--free-totals"], spark)
    (reject,) = VersionedTable(spark, f"{base}/rejects/glassdoor/match").read().collect()
    assert (reject["column"], reject["text"], reject["reason"]) == ("reviews_count", "many", "no long")
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, f"{base}/trusted/glassdoor/match").read()
    jobs.main(["trusted", "--base", base, "--free-totals", "--allow-rejects"], spark)
    trusted = VersionedTable(spark, f"{base}/trusted/glassdoor/match").read()
    assert trusted.count() == len(fixtures.REVIEWS) + 1  # the long line is cut, and kept
