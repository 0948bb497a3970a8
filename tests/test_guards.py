"""No row lost unseen, keys checked at every size, bad tables never published."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from lavra.bindings import ORACLES, QUERIES
from lavra.operators import enforce, enrich_left, expect, measure_reference
from lavra.operators.quality import Gate, QualityError
from lavra.plans.ingest import refuse_repeated, with_total
from lavra.sources import publish_staged, staged_path, write_parquet

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def other_years(spark, tmp_path_factory):
    """The smallest tables with orders of 1990, of 2011 and without a date."""
    folder = tmp_path_factory.mktemp("years")
    for file in SMALL.glob("*.parquet"):
        if file.name != "orders.parquet":
            shutil.copy(file, folder)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    kind = orders.schema["o_orderdate"].dataType.simpleString()
    part = F.pmod("o_orderkey", F.lit(10))
    moved = (
        F.when(part == 1, F.lit("1990-05-06").cast(kind))
        .when(part == 2, F.lit("2011-05-06").cast(kind))
        .when(part != 3, F.col("o_orderdate"))
    )
    one = str(folder / "one")
    orders.withColumn("o_orderdate", moved).coalesce(1).write.parquet(one)
    shutil.copy(next(Path(one).glob("part-*.parquet")), folder / "orders.parquet")
    return str(folder)


@pytest.mark.skipif(not SMALL.exists(), reason="no test tables")
@pytest.mark.parametrize(
    "name",
    ["union_periods", "raw_ingest", "raw_validation", "raw_group_ingest", "raw_to_trusted", "trusted_gates"],
)
def test_orders_of_any_year_are_kept(spark, other_years, name):
    connection = connect(other_years)
    assert differences(spark, connection, QUERIES[name], ORACLES[name], other_years) is None


def test_key_types_are_checked_at_every_size(spark, monkeypatch):
    fact = spark.createDataFrame([(1, "a")], "k long, v string")
    reference = spark.createDataFrame([("1", "x")], "k string, w string")
    measured = measure_reference(reference)
    for limit in (1_000_000, 0):
        monkeypatch.setattr("lavra.operators.join.Reference.fits_broadcast", lambda self: limit > 0)
        with pytest.raises(TypeError):
            enrich_left(fact, measured, "k", {"w": "w"})
    with pytest.raises(TypeError):
        enrich_left(fact, reference, "k", {"w": "w"})


def test_a_repeated_reference_key_is_refused(spark):
    fact = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    twice = measure_reference(spark.createDataFrame([(1, "x"), (1, "y")], "k long, w string"))
    with pytest.raises(ValueError):
        enrich_left(fact, twice, "k", {"w": "w"})
    unkeyed = measure_reference(
        spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k long, w string")
    )
    assert enrich_left(fact, unkeyed, "k", {"w": "w"}).count() == 2


def test_nothing_expected_is_not_checked(spark):
    report = expect(spark.range(3), {"a": Gate(F.count(F.lit(1)), None)})
    assert report.first()["ok"] is None
    enforce(report)
    total = {r["check"]: r for r in with_total(report).collect()}
    assert (total["total"]["actual"], total["total"]["ok"]) == (3, None)


def test_errors_do_not_cancel_in_a_total(spark):
    rows = [("a/t", 1, 3, False), ("b/t", 3, 1, False)]
    report = spark.createDataFrame(rows, "check string, actual long, expected long, ok boolean")
    found = {r["check"]: r["ok"] for r in with_total(report).collect()}
    assert found == {"a/t": False, "b/t": False, "total": True}
    with pytest.raises(QualityError):
        enforce(with_total(report))
    with pytest.raises(ValueError):
        refuse_repeated(["a/t", "b/t", "a/t"])


def test_publishing_replaces_the_old_table_only_when_asked(spark, tmp_path):
    path = str(tmp_path / "table")
    write_parquet(spark.range(3), path)
    write_parquet(spark.range(5), staged_path(path))
    assert spark.read.parquet(path).count() == 3  # a failed gate ends here
    publish_staged(spark, path)
    assert spark.read.parquet(path).count() == 5
    assert not Path(staged_path(path)).exists()
