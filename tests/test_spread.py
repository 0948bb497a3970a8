"""How rows without a key are dealt out, and that planning a join starts no job."""

from __future__ import annotations

from collections import Counter
from statistics import median

import fixtures
import pytest
from pyspark.sql import functions as F

import lavra.operators as op
from lavra import plans
from lavra.operators.join import Reference, spread_hash


@pytest.fixture
def not_adaptive(spark):
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def fact_with_nulls(spark, rows=40_000):
    key = F.when(F.col("id") % 3 != 0, F.concat(F.lit("k"), (F.col("id") % 5000).cast("string")))
    return spark.range(rows).select("id", key.alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"))


def test_rows_without_a_key_are_spread(spark, not_adaptive):
    fact = fact_with_nulls(spark)
    names = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    joined = op.enrich_left(fact, names, "k", {"v": "v"}, flag="hit")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "AdaptiveSparkPlan" not in plan
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * median(sizes)
    assert joined.filter("k IS NULL").count() == joined.filter("NOT hit").count() == 13_334
    assert joined.filter("k IS NOT NULL AND v IS NULL").count() == 0


def test_the_hash_depends_on_the_row_alone(spark):
    fact = fact_with_nulls(spark, 300)
    one = fact.select("id", spread_hash(fact, ["k"]).alias("h"))
    again = fact.repartition(7).orderBy(F.desc("id"))
    two = again.select("id", spread_hash(again, ["k"]).alias("h"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    only = fact.select("k")
    assert only.select(spread_hash(only, ["k"])).distinct().count() > 1


def test_composite_and_repeated_keys_still_match(spark):
    left = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (None, None), (2, "b"), (1, "a")], "x int, y string")
    right = spark.createDataFrame([(1, "a", "u"), (None, "a", "v"), (2, None, "w")], "x int, y string, z string")
    joined = op.enrich_left(left, right, ["x", "y"], {"z": "z"})
    assert Counter(map(tuple, joined.collect())) == Counter(
        [(1, "a", "u"), (1, "a", "u"), (1, None, None), (None, "a", None), (None, None, None), (2, "b", None)]
    )


def tables(spark, rows=400):
    complaints, segments, reviews = fixtures.random_tables(7, rows)
    fact = spark.createDataFrame(complaints, "cnpj_if string, instituicao_financeira string")
    by_id = plans.canonical_segments(spark.createDataFrame(segments, "segmento string, cnpj string, nome string"))
    columns = "segmento string, nome string, employer_name string, reviews_count long, match_percent double"
    by_name = plans.canonical_reviews(spark.createDataFrame(reviews, columns))
    return fact, by_id, by_name, {n: f"gd_{n}" for n in ("segmento", "nome", "employer_name")}


def test_all_ways_of_the_delivery_agree(spark):
    fact, by_id, by_name, added = tables(spark)
    references = op.measure_references(by_id, by_name, on=[plans.TAX_KEY, plans.NAME_KEY])
    ways = [
        plans.deliver(fact, *references, added),
        plans.deliver_in_one_shuffle(fact, by_id, by_name, added),
        plans.deliver_in_one_shuffle(fact, *references, added),
        plans.deliver_by_branch(fact, by_id, by_name, added),
    ]
    expected = Counter(map(tuple, ways[0].collect()))
    for way in ways[1:]:
        assert way.dtypes == ways[0].dtypes
        assert Counter(map(tuple, way.collect())) == expected


def test_the_fact_table_is_read_and_shuffled_once(spark, tmp_path, not_adaptive):
    fact, by_id, by_name, added = tables(spark)
    fact.write.parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    references = [
        Reference(r.table, 10**9, 10**12, r.path, r.keys)
        for r in op.measure_references(by_id, by_name, on=[plans.TAX_KEY, plans.NAME_KEY])
    ]
    plan = plans.deliver(stored, *references, added)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(str(tmp_path / "fact")) == 1
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_names_do_not_match_tax_ids(spark):
    fact = spark.createDataFrame([("123", "x"), (None, "00000123")], "cnpj_if string, instituicao_financeira string")
    by_id = plans.canonical_segments(spark.createDataFrame([("S1", "123", "one")], "segmento string, cnpj string, nome string"))
    columns = "segmento string, nome string, employer_name string, reviews_count long, match_percent double"
    by_name = plans.canonical_reviews(spark.createDataFrame([("S2", "x", "e", 1, 1.0)], columns))
    found = plans.deliver_in_one_shuffle(fact, by_id, by_name, {n: f"gd_{n}" for n in ("segmento", "nome", "employer_name")})
    assert sorted(r["segmento_final"] or "" for r in found.collect()) == ["", "S1"]


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup("planning", "")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_planning_a_delivery_starts_no_job(spark):
    fact, by_id, by_name, added = tables(spark)
    references = op.measure_references(by_id, by_name, on=[plans.TAX_KEY, plans.NAME_KEY])
    assert jobs_of(spark, lambda: plans.deliver(fact, *references, added)) == 0
    large = [Reference(r.table, 10**9, 10**12, r.path, r.keys) for r in references]
    assert jobs_of(spark, lambda: plans.deliver(fact, *large, added)) == 0
    # A reference measured without its keys is looked at when it is used.
    unkeyed = op.measure_references(by_id, by_name)
    assert jobs_of(spark, lambda: plans.deliver(fact, *unkeyed, added)) > 0


def test_repeated_keys_are_counted_while_measuring(spark):
    rows = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (1, "f")]
    reference = op.measure_reference(spark.createDataFrame(rows, "k int, v string"), on="k")
    assert (reference.rows, reference.with_key, reference.repeated) == (6, 4, 2)
    assert reference.table.columns == ["k", "v"]
    fact = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError, match="more than once"):
        op.enrich_left(fact, reference, "k", {"v": "v"})
    assert [r["ok"] for r in reference.key_gates("one per key").collect()] == [False]
    single = op.measure_reference(spark.createDataFrame(rows[2:5], "k int, v string"), on="k")
    assert single.repeated == 0 and op.enrich_left(fact, single, "k", {"v": "v"}).count() == 1
    # Other keys than those it was measured with are counted anew.
    with pytest.raises(ValueError, match="of v more"):
        op.measure_reference(spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string"), on="k").require_unique(["v"])
    with pytest.raises(ValueError, match="without its keys"):
        op.measure_reference(spark.range(1)).key_gates("x")


def test_measuring_a_chosen_reference_takes_no_further_shuffle(spark, not_adaptive):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    chosen = op.canonical(df, ["k"], [F.col("id")])
    before = chosen._jdf.queryExecution().executedPlan().toString().count("Exchange")
    from pyspark.sql import Window

    ranked = chosen.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("k")))
    assert ranked._jdf.queryExecution().executedPlan().toString().count("Exchange") == before
