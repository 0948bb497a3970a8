from __future__ import annotations

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

import lavra.operators as op
from lavra import plans
from lavra.functions.text import first_integer
from lavra.plans import contract
from lavra.sources import SourceSpec, counted_write, read_checked, write_verified


def test_rows_with_unfit_cells_are_set_apart(spark):
    rows = [
        ("a.csv", "1", "1,5"),
        ("a.csv", "x", "2,5"),
        ("b.csv", "y", "z"),
        ("b.csv", None, None),
        ("b.csv", "99999999999999999999", "3"),
        ("b.csv", "y", "z"),  # a repeated row is rejected as often as it occurs
    ]
    df = spark.createDataFrame(rows, "file string, n string, d string")
    n, d = F.col("n"), F.col("d")
    cells = {
        "n": op.cast_cell(n, n.try_cast("long"), "no long"),
        "d": op.cast_cell(d, F.replace(d, F.lit(","), F.lit(".")).try_cast("double"), "no decimal"),
        "file": F.col("file"),
    }
    parts = op.quarantine(df, cells, F.col("file"), op.record_text(["n", "d"], ";"))
    assert parts.good.dtypes == [("n", "bigint"), ("d", "double"), ("file", "string")]
    assert sorted(map(tuple, parts.good.collect()), key=str) == [(1, 1.5, "a.csv"), (None, None, "b.csv")]
    rejects = [tuple(r) for r in parts.rejects.collect()]
    assert sorted(rejects) == sorted(
        [
            ("a.csv", "x;2,5", "n", "x", "no long"),
            ("b.csv", "99999999999999999999;3", "n", "99999999999999999999", "no long"),
            *[("b.csv", "y;z", "n", "y", "no long"), ("b.csv", "y;z", "d", "z", "no decimal")] * 2,
        ]
    )
    assert (parts.rows, parts.rejected_rows, parts.rejected_cells) == (2, 4, 6)
    report = {r["check"]: r["ok"] for r in op.expect(parts.good, parts.gates(6, "t", 0)).collect()}
    assert report == {"t: good and rejected rows": True, "t: rejected rows": False}
    wrong = op.expect(parts.good, parts.gates(7, "t")).collect()
    assert [r["ok"] for r in wrong] == [False, None]


def test_the_quarantine_is_one_job_and_reads_little(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("v"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("quarantine", "")
    parts = op.quarantine(df, {"v": op.cast_cell(F.col("v"), F.col("v").try_cast("int"), "no int")}, F.lit("s"), F.col("v"))
    jobs = len(tracker.getJobIdsForGroup("quarantine"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1
    plan = parts.good._jdf.queryExecution().executedPlan().toString()
    assert "_line" not in plan.split("ReadSchema")[1]
    plan = parts.rejects._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(_rejected,true)" in plan


def test_all_rows_rejected_and_no_rows(spark):
    df = spark.createDataFrame([("x",), ("y",)], "v string")
    cell = {"v": op.cast_cell(F.col("v"), F.col("v").try_cast("int"), "no int")}
    parts = op.quarantine(df, cell, F.lit("s"), F.col("v"))
    assert parts.good.count() == 0 and parts.rejects.count() == 2
    assert [r["ok"] for r in op.expect(parts.good, parts.gates(2, "t", 2)).collect()] == [True, True]
    empty = op.quarantine(df.limit(0), cell, F.lit("s"), F.col("v"))
    assert (empty.rows, empty.rejected_rows, empty.rejected_cells) == (0, 0, 0)
    untyped = op.quarantine(df, {"v": F.col("v")}, F.lit("s"), F.col("v"))
    assert untyped.rows == 2 and untyped.rejects.count() == 0


def test_lines_of_another_layout_are_rejects(spark):
    df = spark.createDataFrame([("1", None), ("2", "1;2;3")], "v string, _malformed string")
    parts = op.quarantine(df, {"v": F.col("v")}, F.lit("s"), F.col("v"), layout=F.col("_malformed"))
    assert [tuple(r) for r in parts.rejects.collect()] == [("s", "2", None, "1;2;3", "layout")]


def test_lenient_integers(column):
    assert column(lambda c: first_integer(c, strict=False), ["2º", "x", "99999999999", None]) == [2, None, None, None]


def test_typed_cells_of_reviews(spark):
    names = contract.REVIEW_COLUMNS
    fit = [("1" if name in [n for ns in contract.REVIEW_TYPES.values() for n in ns] else "t") for name in names]
    unfit = ["many" if name == "reviews_count" else value for name, value in zip(names, fit)]
    raw = spark.createDataFrame([fit, unfit], ", ".join(f"`{n}` string" for n in names))
    parts = plans.quarantined_reviews(raw)
    assert parts.good.dtypes == plans.trusted_reviews(raw).dtypes
    assert parts.good.collect() == plans.trusted_reviews(raw.limit(1)).collect()
    (reject,) = parts.rejects.collect()
    assert (reject["column"], reject["text"], reject["reason"]) == ("reviews_count", "many", "no long")


@pytest.fixture
def delimited(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "good.csv").write_text("a;b;\n1;2;\n3;4;\n")
    (tmp_path / "in" / "bad.csv").write_text("a;b;\n1;2;\n3\n1;2;3;4\n;;\n")
    specs = [SourceSpec(f"{n}.csv", "g", n, ";", "UTF-8", 2) for n in ("good", "bad")]
    return tmp_path, specs


def test_ingest_reports_and_keeps_malformed_lines(spark, delimited):
    base, specs = delimited
    folder = {name: str(base / name) for name in ("in", "raw", "rejects")}
    report = plans.ingest(spark, specs, folder["in"], folder["raw"], rejects=folder["rejects"])
    found = {r["check"]: (r["actual"], r["ok"]) for r in report.collect()}
    assert found["good.csv: malformed lines"] == (0, True)
    assert found["bad.csv: malformed lines"] == (2, False)
    assert found["bad.csv: rows stored"] == (4, True)
    rejects = plans.read_rejects(spark, specs, folder["rejects"]).collect()
    assert sorted((r["source"], r["line"], r["reason"]) for r in rejects) == [
        ("bad.csv", "1;2;3;4", "layout"),
        ("bad.csv", "3", "layout"),
    ]
    # What is stored is what a plain ingest stores.
    plans.ingest(spark, specs, folder["in"], str(base / "plain"))
    for name in ("good", "bad"):
        checked = spark.read.parquet(f"{folder['raw']}/g/{name}")
        plain = spark.read.parquet(f"{base}/plain/g/{name}")
        assert checked.schema == plain.schema
        assert sorted(map(str, checked.collect())) == sorted(map(str, plain.collect()))


def test_checked_reading_names_columns_by_the_header(spark, delimited):
    base, _ = delimited
    assert read_checked(spark, str(base / "in" / "bad.csv"), ";").columns == ["a", "b", "_c2", "_malformed"]


# --- content checksum ---------------------------------------------------------------

SCHEMA = "i int, l long, s string, d double, m decimal(9,2), t date, b binary, a array<int>, p map<string,int>"
ROWS = [
    (1, 2, "x", 0.5, decimal.Decimal("1.50"), datetime.date(2020, 1, 1), b"\x00", [1, None], {"k": 1}),
    (None, 2, "", -0.0, None, None, None, [None, 1], None),
    (1, None, None, float("nan"), None, None, None, None, None),
    (1, None, None, float("nan"), None, None, None, None, None),
]


def checksum(df, **kwargs):
    return df.agg(op.content_sum(df, **kwargs)).first()[0]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_order_of_rows_and_columns_is_no_matter(spark, table):
    expected = checksum(table)
    assert checksum(table.repartition(3).orderBy("s")) == expected
    assert checksum(table.select(*reversed(table.columns))) == expected
    zero = spark.createDataFrame([(r[0], r[1], r[2], 0.0 if r[3] == 0 else r[3], *r[4:]) for r in ROWS], SCHEMA)
    assert checksum(zero) == expected
    assert checksum(table.limit(0)) == 0


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("l", F.coalesce("l", F.lit(0)).cast("long")),
        lambda df: df.withColumn("s", F.nullif(F.col("s"), F.lit(""))),
        lambda df: df.withColumn("i", F.col("i").cast("long")),
        lambda df: df.withColumnRenamed("i", "j"),
        lambda df: df.withColumns({"i": F.col("l").cast("int"), "l": F.col("i").cast("long")}),
        lambda df: df.withColumn("a", F.array_compact("a")),
        lambda df: df.union(df.limit(1)),
        lambda df: df.distinct(),  # equal rows do not cancel each other
        lambda df: df.withColumn("d", F.nanvl("d", F.lit(1.0))),
    ],
)
def test_any_change_changes_the_sum(table, change):
    plain = table.drop("p")
    assert checksum(change(plain)) != checksum(plain)


def test_a_changed_cell_fails_the_gate_and_counts_do_not_see_it(spark, table, tmp_path):
    result, report = write_verified(table, str(tmp_path / "t"), "t", content=True)
    assert [r["ok"] for r in report.collect()] == [True, True]
    changed = result.read(spark).withColumn("s", F.when(F.col("s") == "x", "y").otherwise(F.col("s")))
    gates = op.expect(changed, op.content_gates(changed, "t", result.rows, result.checksum))
    assert {r["check"]: r["ok"] for r in gates.collect()} == {"t: rows": True, "t: content kept": False}
    with pytest.raises(op.QualityError, match="content kept"):
        op.enforce(gates)
    assert op.same_content(table, result.read(spark), "t").filter("NOT ok").isEmpty()


def test_partitioned_tables_keep_their_types(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("2", 2), (None, 3)], "k string, v int")
    _, report = write_verified(df, str(tmp_path / "t"), "t", ["k"], content=True)
    # A folder name says 1 for "01": the gate sees what a count does not.
    assert {r["check"]: r["ok"] for r in report.collect()} == {
        "t: rows stored": True,
        "t: content kept": False,
    }
    plain = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    _, report = write_verified(plain, str(tmp_path / "p"), "p", ["k"], content=True)
    assert all(r["ok"] for r in report.collect())


def test_sums_of_many_rows_do_not_overflow(spark):
    df = spark.range(200_000).withColumn("v", F.lit(None).cast("string"))
    both = df.union(df)
    assert checksum(both) == 2 * checksum(df) % (1 << 62)
    assert counted_write(df, str(spark.conf.get("spark.checkpoint.dir")) + "/sum", content=True).checksum == checksum(df)


def test_portable_sum_refuses_types_whose_text_differs(table):
    with pytest.raises(TypeError, match="double"):
        op.portable_sum(table.select("s", "d"))
