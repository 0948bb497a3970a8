"""Publishing in one step: whatever fails on the way, the old version stays readable."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lavra import plans
from lavra.operators import Gate
from lavra.plans import publish
from lavra.sources import JdbcTarget, PublishError, VersionedTable, publish_all, sink


@pytest.fixture
def table(spark, tmp_path):
    found = VersionedTable(spark, str(tmp_path / "t"))
    found.replace(spark.range(3), "first")
    return found


def test_nothing_is_published_at_first(spark, tmp_path):
    new = VersionedTable(spark, str(tmp_path / "new"))
    assert new.log() == [] and new.current() is None
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        new.read()
    version, result, report = new.write(spark.range(2), "new", content=True)
    assert result.rows == 2 and report.filter("NOT ok").isEmpty()
    with pytest.raises(FileNotFoundError):
        new.read()
    assert new.publish(version).number == 1 and new.read().count() == 2


def test_versions_follow_each_other_and_go_back(spark, table):
    first = table.current()
    table.replace(table.read().union(table.read()), "second")  # from what it replaces
    assert table.read().count() == 6 and len(table.log()) == 2
    table.publish(first)
    assert table.read().count() == 3 and [e.number for e in table.log()] == [1, 2, 3]


def test_a_reader_of_the_old_version_is_not_disturbed(spark, table):
    reader = table.read()
    table.replace(spark.range(10), "second")
    assert reader.count() == 3


def test_a_failing_write_leaves_the_old_version(spark, table):
    broken = spark.range(4).select((F.lit(1) / (F.col("id") - 2)).alias("id"))
    with pytest.raises(Exception):
        table.replace(broken, "second")
    assert table.read().count() == 3
    (left,) = table.drop_unpublished()
    with pytest.raises(PublishError, match="not written to its end"):
        table.publish(left)


def test_a_failing_marker_leaves_the_old_version(spark, table, monkeypatch):
    version, _, _ = table.write(spark.range(4), "second")

    class Failing:
        """The store, but for the last step of publishing."""

        def __init__(self, store, calls):
            self.store, self.calls = store, calls

        def __getattr__(self, name):
            return getattr(self.store, name)

        def create(self, path, overwrite):
            if self.calls == 0:
                raise OSError("no space")
            self.calls -= 1
            return self.store.create(path, overwrite)

    real = VersionedTable._store
    for calls in (0, 1):
        monkeypatch.setattr(VersionedTable, "_store", lambda self, n=calls: Failing(real(self), n))
        with pytest.raises(OSError, match="no space"):
            table.publish(version)
        monkeypatch.undo()
        assert table.read().count() == 3


def test_a_number_is_given_once(spark, table, monkeypatch):
    one, _, _ = table.write(spark.range(4), "one")
    two, _, _ = table.write(spark.range(5), "two")
    log = table.log()
    monkeypatch.setattr(VersionedTable, "log", lambda self: log)  # both saw the same log
    table.publish(one)
    with pytest.raises(PublishError, match="another job"):
        table.publish(two)
    monkeypatch.undo()
    assert table.read().count() == 4
    table.publish(two)
    assert table.read().count() == 5


def test_several_tables_together(spark, table, tmp_path, monkeypatch):
    other = VersionedTable(spark, str(tmp_path / "o"))
    other.replace(spark.range(7), "first")
    a, b = table.write(spark.range(1), "a")[0], other.write(spark.range(2), "b")[0]
    with pytest.raises(PublishError):
        publish_all([(table, a), (other, "unknown")])
    assert (table.read().count(), other.read().count()) == (3, 7)
    real = VersionedTable.publish

    def failing(self, version):
        if version == b:
            raise PublishError("lost")
        return real(self, version)

    monkeypatch.setattr(VersionedTable, "publish", failing)
    with pytest.raises(PublishError, match="lost"):
        publish_all([(table, a), (other, b)])
    monkeypatch.undo()
    assert (table.read().count(), other.read().count()) == (3, 7)
    publish_all([(table, a), (other, b)])
    assert (table.read().count(), other.read().count()) == (1, 2)


def test_old_versions_are_dropped(spark, table):
    first = table.current()
    for n in (4, 5):
        table.replace(spark.range(n), "next")
    waiting, _, _ = table.write(spark.range(9), "waiting")
    assert table.drop_old(keep=2) == [first]
    assert table.read().count() == 5 and table.read(table.log()[1].version).count() == 4
    with pytest.raises(Exception):
        table.read(first).count()
    table.publish(waiting)
    assert table.drop_unpublished() == [] and table.read().count() == 9
    assert len(table.drop_old(keep=0)) >= 2 and table.read().count() == 9


def test_the_final_table_is_checked_before_it_is_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "final")
    plans.materialize_final(spark.range(3), path)
    old = VersionedTable(spark, path)
    sent = []
    monkeypatch.setattr(publish, "publish_table", lambda *a, **k: sent.append(a))
    # A gate of the caller fails.
    _, report = plans.materialize_final(
        spark.range(9), path, JdbcTarget("jdbc:x", "t"), {"rows": Gate(F.count(F.lit(1)), 8)}
    )
    assert [r["check"] for r in report.filter("NOT ok").collect()] == ["rows"]
    assert old.read().count() == 3 and not sent

    # What is stored is not what was written: a count alone does not see it.
    real = sink.counted_write

    def lossy(df, folder, *args):
        result = real(df, folder, *args)
        spark.range(100, 109).write.mode("overwrite").parquet(folder)
        return result

    monkeypatch.setattr(sink, "counted_write", lossy)
    _, report = plans.materialize_final(spark.range(9), path)
    assert [r["check"] for r in report.filter("NOT ok").collect()] == ["final table: content kept"]
    assert old.read().count() == 3
    monkeypatch.undo()
    plans.materialize_final(spark.range(9), path)
    assert old.read().count() == 9
