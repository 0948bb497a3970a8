from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lavra import operators as op
from lavra.operators.join import Reference, row_bytes


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_rename_by_position_checks_arity(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    renamed = op.rename_by_position(frame, ["x", "y", "_c"], drop=["_c"])
    assert renamed.columns == ["x", "y"]
    with pytest.raises(ValueError, match="2 columns expected, 3 found"):
        op.rename_by_position(frame, ["x", "y"])


def test_map_columns_is_one_projection(spark):
    frame = spark.createDataFrame([(" a ", " b ")], "a string, b string")
    assert op.map_columns(frame, F.trim, ["a"]).collect() == [("a", " b ")]
    assert op.map_columns(frame, F.trim).collect() == [("a", "b")]


def test_choosing_columns(spark):
    frame = spark.createDataFrame([("a", 1, "b")], "s string, n int, t string")
    assert op.columns_of_type(frame) == ["s", "t"]
    assert op.available_columns(frame, ["t", "zz", "s", "t"]) == ["t", "s"]


def test_cast_columns_strict_and_lenient(spark):
    frame = spark.createDataFrame([("1", "2.5"), ("1300.0", "x")], "a string, b string")
    types = {"long": ["a"], "double": ["b", "absent"]}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        op.cast_columns(frame, types).collect()
    assert rows(op.cast_columns(frame, types, strict=False)) == Counter(
        [(1, 2.5), (None, None)]
    )
    assert rows(op.cast_rejects(frame, types)) == Counter(
        [("a", "long", 2, 1), ("b", "double", 2, 1)]
    )
    with pytest.raises(ValueError, match="absent"):
        op.cast_columns(frame, types, only_existing=False)


def test_unions(spark):
    one = spark.createDataFrame([(1, "a")], "n int, s string")
    two = spark.createDataFrame([("b", 2)], "s string, n int")
    other = spark.createDataFrame([(3, True)], "n int, b boolean")
    assert rows(op.union_strict([one, two])) == Counter([(1, "a"), (2, "b")])
    with pytest.raises(Exception, match="Cannot resolve column name"):
        op.union_strict([one, other])
    assert rows(op.union_filled([one, other])) == Counter([(1, "a", None), (3, None, True)])


def test_schema_diff(spark):
    left = spark.createDataFrame([], "a int, b string, c int")
    right = spark.createDataFrame([], "a long, c int, d int")
    assert rows(op.schema_diff(left, right)) == Counter(
        [
            ("a", "type_changed", "int", "bigint"),
            ("b", "missing", "string", None),
            ("d", "extra", None, "int"),
        ]
    )
    assert op.schema_diff(left, left).count() == 0


def test_canonical_orders_nulls_and_breaks_ties(spark):
    frame = spark.createDataFrame(
        [
            ("k", 2, None, "b"),
            ("k", None, "z", "a"),
            ("k", 2, "n", "a"),
            (None, 1, "x", "y"),
            (None, 5, "x", "y"),
            ("t", 1, "s", "b"),
            ("t", 1, "s", "a"),
        ],
        "k string, score int, name string, extra string",
    )
    chosen = op.canonical(
        frame, ["k"], [F.col("score").desc_nulls_last(), F.col("name").asc_nulls_first()]
    )
    assert rows(chosen) == Counter(
        [("k", 2, None, "b"), (None, 5, "x", "y"), ("t", 1, "s", "a")]
    )


def test_canonical_cuts_groups_before_the_shuffle(spark):
    frame = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = op.canonical(frame, ["k"], [F.col("id")])._jdf.queryExecution().toString()
    assert "row_number(), 1, Partial" in plan
    assert plan.index("row_number(), 1, Final") < plan.index("row_number(), 1, Partial")


def test_duplicates_and_check(spark):
    frame = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string"
    )
    assert rows(op.duplicate_keys(frame, ["k"])) == Counter([(1, 2), (None, 2)])
    assert rows(op.duplicate_rows(frame, ["k"])) == Counter([(1, "a"), (1, "b")])
    assert op.duplicate_summary(frame, ["k"]).first() == (2, 4)
    assert op.duplicate_summary(frame, ["v"]).first() == (0, 0)
    kept = op.canonical(frame, ["k"], [F.col("v")])
    assert op.canonical_check(frame, kept, ["k"]).first() == (3, 3, 0)
    assert op.canonical_check(frame, frame, ["k"]).first() == (3, 3, 2)


def fact_and_reference(spark):
    fact = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), (None, 4), ("c", 5)], "k string, n int"
    )
    reference = spark.createDataFrame(
        [("a", "A"), ("b", None), (None, "N"), ("z", "Z")], "k string, label string"
    )
    return fact, reference


@pytest.mark.parametrize("measured", [False, True])
def test_enrich_left_keeps_every_row(spark, measured):
    fact, reference = fact_and_reference(spark)
    source = op.measure_reference(reference) if measured else reference
    by_key = op.enrich_left(fact, source, "k", {"label": "label_ref"}, flag="hit")
    assert by_key.columns == ["k", "n", "label_ref", "hit"]
    assert rows(by_key) == Counter(
        [
            ("a", 1, "A", True),
            ("a", 2, "A", True),
            ("b", 3, None, True),
            (None, 4, None, False),
            ("c", 5, None, False),
        ]
    )
    by_value = op.enrich_left(
        fact, source, "k", {"label": "l"}, flag="hit", flag_from="l"
    ).filter("hit")
    assert rows(by_value.select("n")) == Counter([(1,), (2,)])


def test_measured_reference_is_broadcast_only_within_its_limit(spark):
    fact, reference = fact_and_reference(spark)
    measured = op.measure_reference(reference)
    assert measured.rows == 4 and measured.bytes > 0
    small = op.enrich_left(fact, measured, "k", {"label": "l"})
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    large = Reference(measured.table, 10**9, 10**12, measured.path)
    shuffled = op.enrich_left(fact, large, "k", {"label": "l"})
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().toString()
    assert rows(shuffled) == rows(small)


def test_row_bytes_counts_repeated_text_in_full(spark):
    frame = spark.range(100).select(F.repeat(F.lit("x"), F.lit(1000)).alias("s"), "id")
    assert frame.agg(F.sum(row_bytes(frame))).first()[0] >= 100 * 1008


def test_key_types_must_agree(spark):
    fact, reference = fact_and_reference(spark)
    other = reference.withColumn("k", F.lit(1))
    with pytest.raises(TypeError, match="key k is string and int"):
        op.enrich_left(fact, other, "k", {"label": "l"})


@pytest.fixture
def skewed(spark):
    """A fact table a third of which has one key and a third has none."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    kind = F.col("id") % 3
    fact = spark.range(0, 120_000, 1, 16).select(
        "id",
        F.when(kind == 0, "hot").when(kind == 2, F.col("id").cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    reference = spark.range(0, 60_000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    yield fact, reference
    for name, value in before.items():
        spark.conf.set(name, value)


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_in_every_join_of_rows(skewed):
    fact, reference = skewed
    once = op.canonical(reference, ["k"], [F.col("v")])
    enriched = op.enrich_left(fact, once, "k", {"v": "v"}, flag="hit")
    assert "skew=true" in executed(enriched.agg(F.count("*"), F.max("pad"), F.count_if("hit")))
    total, hits, best = enriched.agg(F.count("*"), F.count_if("hit"), F.max("v")).first()
    assert total == 120_000
    assert hits == 40_000 + len(range(2, 60_000, 3))
    for frame in (op.duplicate_rows(fact, ["k"]), op.unmatched_rows(fact, once, ["k"])):
        assert "skew=true" in executed(frame.agg(F.count("*"), F.max("pad")))
    assert op.duplicate_rows(fact, ["k"]).count() == 40_000


def test_key_sets_and_coverage(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    assert rows(op.matched_keys(left, right, ["k"])) == Counter([("a",)])
    assert rows(op.unmatched_keys(left, right, ["k"])) == Counter([("b",), (None,)])
    assert rows(op.unmatched_rows(left, right, ["k"])) == Counter([("b",)])
    found = op.key_coverage(left, right, ["k"]).first()
    assert tuple(found)[:3] == (3, 1, 2)
    assert found["coverage_percent"] == pytest.approx(100 / 3)
    nothing = op.key_coverage(left.limit(0), right, ["k"]).first()
    assert tuple(nothing) == (0, 0, 0, 0.0)
    flagged = op.flag_matches(left, right, "k", "hit")
    assert rows(flagged) == Counter({("a", True): 2, ("b", False): 1, (None, False): 1})
    measured = op.flag_matches(left, op.measure_keys(right, ["k"]), "k", "hit")
    assert rows(measured) == rows(flagged)
    assert tuple(op.row_coverage(flagged, ["hit"]).first()) == (4, 2, 2, 50.0)
    assert tuple(op.row_coverage(flagged.limit(0), ["hit"]).first()) == (0, 0, 0, 0.0)


def test_composite_keys_on_random_rows_agree_with_sets(spark):
    random.seed(7)
    pick = lambda n: [
        (random.choice("abcd"), random.choice([1, 2, 3, None])) for _ in range(n)
    ]
    left, right = pick(60), pick(8)
    schema = "s string, n int"
    here, there = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    known = {key for key in right if None not in key}
    keys = ["s", "n"]
    assert {tuple(r) for r in op.matched_keys(here, there, keys).collect()} == set(left) & known
    assert {tuple(r) for r in op.unmatched_keys(here, there, keys).collect()} == set(left) - known
    coverage = op.key_coverage(here, there, keys).first()
    assert (coverage["n_keys"], coverage["found"]) == (len(set(left)), len(set(left) & known))


def test_distinct_counts_with_and_without_null(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "n int, s string")
    assert rows(op.distinct_counts(frame, ["n", "s"])) == Counter([("n", 2, 2), ("s", 1, 2)])


def test_reports_take_any_header_text(spark):
    names = ["Qtd. total – CCS", "a`b", "x y"]
    frame = spark.createDataFrame([(" 1 ", None, "�")], "a string, b string, c string").toDF(*names)
    assert rows(op.null_profile(frame)) == Counter(zip(names, [1, 1, 1], [0, 1, 0]))
    assert rows(op.char_scan(frame)) == Counter(zip(names, [0, 0, 1]))
    assert rows(op.map_columns(frame, F.trim)) == Counter([("1", None, "�")])
    assert op.cast_columns(frame, {"long": names[:2]}).collect() == [(1, None, "�")]
    assert rows(op.distinct_counts(frame, names[:1])) == Counter([(names[0], 1, 1)])
    assert rows(op.cast_rejects(frame, {"int": names[2:]})) == Counter([("x y", "int", 1, 1)])


def test_profiles(spark):
    frame = spark.createDataFrame(
        [("a�", "123456789"), (None, "0"), ("b", "x")], "name string, id string"
    )
    assert rows(op.null_profile(frame)) == Counter([("name", 3, 1), ("id", 3, 0)])
    assert rows(op.char_scan(frame)) == Counter([("name", 1), ("id", 0)])
    assert rows(op.char_rows(frame, "name", ["id", "none"])) == Counter([("123456789", "a�")])
    assert rows(op.key_length_profile(frame, "id")) == Counter([(9, 1), (1, 1), (None, 1)])
    assert op.key_exceptions(frame, "id").first() == (1, 1)
    assert rows(op.column_fill(frame)) == Counter([("name", "string", 2), ("id", "string", 3)])


def test_gates_report_and_enforce(spark):
    frame = spark.createDataFrame([(2020,), (2021,), (None,)], "year int")
    report = op.expect(
        frame,
        {
            "rows": op.Gate(F.count(F.lit(1)), 3),
            "years": op.Gate(op.domain_breaches("year", [2021, 2022]), 0),
        },
    )
    assert rows(report) == Counter([("rows", 3, 3, True), ("years", 2, 0, False)])
    op.enforce(report.filter("ok"))
    with pytest.raises(op.QualityError, match="years: found 2, expected 0"):
        op.enforce(report)


def test_blank_column_gates(spark):
    frame = spark.createDataFrame([(" ", "x"), (None, None)], "b string, f string")
    reports = [op.expect(frame, op.blank_column(frame, name)) for name in ("b", "f", "gone")]
    assert rows(op.stack_reports(reports)) == Counter(
        [("b filled", 0, 0, True), ("f filled", 1, 0, False), ("gone exists", 0, 1, False)]
    )


def test_compare_metrics_flags_labels_on_one_side(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "check string, actual long")
    right = spark.createDataFrame([("a", 1), ("c", 2)], "check string, actual long")
    assert rows(op.compare_metrics(left, right)) == Counter(
        [("a", 1, 1, True), ("b", 2, None, False), ("c", None, 2, False)]
    )


def test_preview_is_a_top_n(spark):
    frame = spark.range(100).withColumn("g", F.col("id") % 3)
    top = op.preview(frame, 4, ["g", "id"], ["g", F.col("id").desc()])
    assert [tuple(r) for r in top.collect()] == [(0, 99), (0, 96), (0, 93), (0, 90)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().toString()
