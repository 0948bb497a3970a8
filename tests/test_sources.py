from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lavra import sources as src
from lavra.operators import rename_by_position
from lavra.session import scratch_path


def rows(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture
def latin_file(tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("id;instituição;\r\n1;A \x96 São;\r\n2;  ;\r\n3\r\n4;x;y;z\r\n".encode("latin-1"))
    return path


def test_delimited_text_is_never_inferred(spark, latin_file):
    frame = src.read_delimited(spark, str(latin_file), ";", "ISO-8859-1")
    assert frame.columns == ["id", "instituição", "_c2"]
    assert {t for _, t in frame.dtypes} == {"string"}
    assert rows(frame) == Counter(
        [("1", "A \x96 São", None), ("2", "  ", None), ("3", None, None), ("4", "x", "y")]
    )


def test_group_scan_names_by_position_and_finds_malformed_lines(spark, tmp_path, latin_file):
    other = tmp_path / "other.csv"
    other.write_bytes("ID;NAME;\r\n9;ç;\r\n".encode("latin-1"))
    frame = src.read_group(
        spark,
        [str(latin_file), str(other)],
        ["id", "name", "_c"],
        ";",
        "ISO-8859-1",
        source_column="source",
        keep_malformed=True,
    )
    found = {(r["source"], r["id"], r["name"], r["_malformed"] is not None) for r in frame.collect()}
    assert found == {
        ("latin.csv", "1", "A \x96 São", False),
        ("latin.csv", "2", "  ", False),
        ("latin.csv", "3", None, True),
        ("latin.csv", "4", "x", True),
        ("other.csv", "9", "ç", False),
    }


def test_probes_compare_charsets_and_separators(spark, latin_file):
    probe = src.charset_probe(spark, str(latin_file), ";", ["ISO-8859-1", "UTF-8"])
    assert rows(probe.select("source", "n_rows", "n_columns", "n_hits")) == Counter(
        [("ISO-8859-1", 4, 3, 0), ("UTF-8", 4, 3, 1)]
    )
    spec = src.SourceSpec(latin_file.name, "g", "t", "|", "ISO-8859-1")
    structure = src.structure_probe(spark, [spec], str(latin_file.parent)).first()
    assert (structure["source"], structure["n_columns"]) == ("latin.csv", 1)


def test_lines_and_byte_patterns(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_bytes(b"a\xef\xbf\xbdb\xef\xbf\xbd\r\n\r\nplain\n\xef\xbf\xbd\n")
    lines = src.read_lines(spark, str(path))
    assert rows(src.line_counts(lines)) == Counter([("lines.txt", 4)])
    assert src.first_lines(spark, str(path), 2).count() == 2
    latin = src.read_lines(spark, str(path), "ISO-8859-1")
    pattern = b"\xef\xbf\xbd".decode("latin-1")
    assert rows(src.line_occurrences(latin, pattern)) == Counter([("lines.txt", 2, 3)])


@pytest.mark.parametrize("limit", [0, 5, 10**6])
def test_manifest_hashes_small_and_large_files_alike(spark, tmp_path, limit):
    contents = {"a.bin": b"", "b.bin": b"12345", "c é.bin": b"x" * 70_000, "p+q%20.bin": b"p", "skip.txt": b"no"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    manifest = src.file_manifest(spark, str(tmp_path), "*.bin", whole_file_bytes=limit)
    assert rows(manifest) == Counter(
        (n, len(c), hashlib.sha256(c).hexdigest().upper())
        for n, c in contents.items()
        if n.endswith(".bin")
    )


def test_large_files_are_spread_over_tasks(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"{i}.bin").write_bytes(str(i).encode())
    manifest = src.file_manifest(spark, str(tmp_path), whole_file_bytes=0)
    manifest.collect()
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_copies_are_compared_file_by_file(spark):
    schema = "file string, size_bytes long, sha256 string"
    left = spark.createDataFrame([("a", 1, "X"), ("b", 1, "Y"), ("c", 1, "Z")], schema)
    right = spark.createDataFrame([("a", 1, "X"), ("b", 1, "W"), ("d", 1, "V")], schema)
    assert rows(src.compare_manifests(left, right)) == Counter(
        [
            ("a", "X", "X", True),
            ("b", "Y", "W", False),
            ("c", "Z", None, False),
            ("d", None, "V", False),
        ]
    )


def test_verified_write(spark, tmp_path):
    frame = spark.range(25).select("id", (F.col("id") % 2).alias("p"))
    result, report = src.write_verified(frame, str(tmp_path / "t"), "t", ["p"])
    assert (result.rows, result.columns) == (25, 2)
    assert rows(report) == Counter([("t: rows stored", 25, 25, True)])
    again, _ = src.write_verified(frame.limit(3), str(tmp_path / "t"), "t")
    assert again.rows == 3 and again.read(spark).count() == 3


def test_delimited_round_trip_keeps_blank_last_column(spark, tmp_path):
    frame = spark.createDataFrame([("á", None), ("b;c", None)], "s string, _c1 string")
    src.write_delimited(frame, str(tmp_path / "out"), ";", "ISO-8859-1")
    back = src.read_delimited(spark, str(tmp_path / "out"), ";", "ISO-8859-1")
    assert rows(back) == Counter([("á", None), ("b;c", None)])
    assert rename_by_position(back, ["x", "y"], drop=["y"]).columns == ["x"]


def test_scratch_paths_lie_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(f"{base}/lavra/x-")


class Recorder:
    """Stands in for a Spark reader or writer and notes what it is told."""

    def __init__(self):
        self.told = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            if name == "option":
                self.told[args[0]] = args[1]
            elif name == "options":
                self.told.update(kwargs)
            else:
                self.told[name] = args or kwargs or True
            return self

        return call


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()


TARGET = src.JdbcTarget("jdbc:x:y", "public.t", {"user": "u", "driver": "d"})


def test_jdbc_write_bounds_connections_and_can_keep_the_table():
    frame = Holder()
    src.write_jdbc(frame, TARGET, connections=4, truncate=True, column_types="s VARCHAR(10)")
    told = frame.write.told
    assert told["url"] == "jdbc:x:y" and told["dbtable"] == "public.t" and told["user"] == "u"
    assert (told["numPartitions"], told["truncate"], told["batchsize"]) == (4, True, 10_000)
    assert told["createTableColumnTypes"] == "s VARCHAR(10)"
    assert told["mode"] == ("overwrite",) and told["save"] is True


def test_jdbc_counts_are_left_to_the_database():
    session = Holder()
    src.count_jdbc(session, TARGET)
    told = session.read.told
    assert told["query"] == "SELECT COUNT(*) AS n_rows FROM public.t"
    assert told["url"] == "jdbc:x:y" and told["driver"] == "d" and "dbtable" not in told


def test_jdbc_read_splits_by_range_or_predicates():
    session = Holder()
    src.read_jdbc(session, TARGET, "id", 0, 100, 8)
    told = session.read.told
    assert (told["partitionColumn"], told["lowerBound"], told["upperBound"]) == ("id", 0, 100)
    assert told["numPartitions"] == 8 and told["load"] is True
    by_predicate = Holder()
    src.read_jdbc(by_predicate, TARGET, predicates=["ano = 2021", "ano = 2022"])
    assert "jdbc" in by_predicate.read.told
    with pytest.raises(ValueError, match="lower, upper and partitions"):
        src.read_jdbc(Holder(), TARGET, "id")
