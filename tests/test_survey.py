"""Many sources in one scan, charsets told from bytes, Windows-1252."""

from __future__ import annotations

import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lavra import sources as src
from lavra.functions.text import WINDOWS_1252_CHARACTERS, WINDOWS_1252_CONTROLS, windows_1252
from lavra.sources import Reading, best_charset, survey
from lavra.sources.survey import byte_classes, fields, header_names


def only(frame):
    (row,) = frame.collect()
    return row.asDict()


def test_windows_1252_has_27_characters_of_its_own(column):
    assert len(WINDOWS_1252_CHARACTERS) == len(WINDOWS_1252_CONTROLS) == 27
    assert "€" in WINDOWS_1252_CHARACTERS and "–" in WINDOWS_1252_CHARACTERS
    texts = [chr(b) for b in range(256)] + ["a\x96b é", None, ""]
    expected = [None if t is None else t.encode("latin-1").decode("cp1252", "replace") for t in texts]
    expected = [t if e is None or "�" in e else e for t, e in zip(texts, expected)]
    assert column(windows_1252, texts) == expected


@pytest.mark.parametrize("name", ["windows-1252", "cp1252", "WINDOWS_1252"])
def test_all_characters_are_read(spark, tmp_path, name):
    path = tmp_path / "w.csv"
    text = "id;preço €\n" + "".join(f"{i};{c}\n" for i, c in enumerate(WINDOWS_1252_CHARACTERS))
    path.write_bytes(text.encode("cp1252"))
    table = src.read_delimited(spark, str(path), ";", name)
    assert table.columns == ["id", "preço €"]
    assert "".join(r[1] for r in sorted(table.collect(), key=lambda r: int(r[0]))) == WINDOWS_1252_CHARACTERS
    group = src.read_group(spark, [str(path)], ["id", "c"], ";", name, "file", keep_malformed=True)
    assert group.columns == ["id", "c", "_malformed", "file"]
    assert {r["c"] for r in group.collect()} == set(WINDOWS_1252_CHARACTERS)
    checked = src.read_checked(spark, str(path), ";", name)
    assert checked.columns == ["id", "preço €", "_malformed"] and checked.count() == 27
    lines = src.read_lines(spark, str(path), name)
    assert lines.filter(F.col("value").contains("€")).count() == 2


def test_sources_of_all_kinds_in_one_scan(spark, tmp_path):
    files = {
        "utf8.csv": "a;b;\n1;é;\n\n2;x\n3;y;;z\n".encode(),
        "latin.csv": "id|nome|nome\n1|São|x\n".encode("latin-1"),
        "windows.csv": "a\tb\n1\t–\n2\t€\n".encode("cp1252"),
        "broken.csv": "título;v\n1;".encode() + b"\xe9\n",
        "plain.csv": b"a;b\n1;2\n",
        "empty.csv": b"",
        "blank.csv": b"\n  \n",
        "quoted é.csv": 'a;"b;c"\n1;"2;3"\n'.encode(),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "folder").mkdir()
    for i in range(3):
        (tmp_path / "folder" / f"{i}.csv").write_text("k;v\n" + "1;2\n" * (i + 1))
    kinds = {"latin.csv": ("|", "ISO-8859-1"), "windows.csv": ("\t", "windows-1252")}
    readings = [
        Reading(name, str(tmp_path / name), *kinds.get(name, (";", "UTF-8")))
        for name in [*files, "folder"]
    ]
    found = {r["source"]: r.asDict() for r in survey(spark, readings).collect()}

    def shape(name):
        row = found[name]
        return row["n_files"], row["n_rows"], row["n_columns"], row["column_names"], row["n_hits"], row["n_malformed"], row["best"]

    assert shape("utf8.csv") == (1, 3, 3, ["a", "b", "_c2"], 0, 2, True)
    assert shape("latin.csv") == (1, 1, 3, ["id", "nome1", "nome2"], 0, 0, True)
    assert shape("windows.csv") == (1, 2, 2, ["a", "b"], 0, 0, True)
    assert shape("broken.csv") == (1, 1, 2, ["título", "v"], 1, 0, False)
    assert shape("plain.csv") == (1, 1, 2, ["a", "b"], 0, 0, True)
    assert shape("empty.csv") == (0, 0, 0, [], 0, 0, None)
    assert shape("blank.csv") == (0, 0, 0, [], 0, 0, None)
    assert shape("quoted é.csv") == (1, 1, 2, ["a", "b;c"], 0, 0, True)
    assert shape("folder") == (3, 6, 2, ["k", "v"], 0, 0, True)
    # Names and rows are those of the reader of delimited text.
    for name in ("utf8.csv", "latin.csv", "windows.csv", "broken.csv", "plain.csv", "quoted é.csv"):
        sep, charset = kinds.get(name, (";", "UTF-8"))
        table = src.read_delimited(spark, str(tmp_path / name), sep, charset)
        assert (table.columns, table.count()) == (found[name]["column_names"], found[name]["n_rows"])


def test_one_source_under_all_charsets(spark, tmp_path):
    texts = {"UTF-8": "São – €", "ISO-8859-1": "São", "windows-1252": "São – €"}
    for charset, text in texts.items():
        path = tmp_path / charset
        path.write_bytes(f"a;b\n1;{text}\n".encode(charset))
        probe = src.detect_charset(spark, str(path), ";")
        assert {r["charset"] for r in probe.filter("best").collect()} == {charset}
        assert probe.count() == 3
    undefined = tmp_path / "undefined"
    undefined.write_bytes(b"a;b\n1;\x81\xe9\n")
    assert only(src.detect_charset(spark, str(undefined), ";").filter("best"))["charset"] == "ISO-8859-1"


def test_repeated_readings_and_unknown_charsets_are_refused(spark, tmp_path):
    (tmp_path / "a").write_text("a\n")
    one = Reading("a", str(tmp_path / "a"), ";")
    with pytest.raises(ValueError, match="share"):
        survey(spark, [one, one])
    with pytest.raises(ValueError, match="UTF-7"):
        survey(spark, [Reading("a", str(tmp_path / "a"), ";", "UTF-7")])


def test_lines_are_not_sorted_to_be_counted(spark, tmp_path):
    """Between the scan and the groups of a task, whose memory would follow the lines."""
    (tmp_path / "a").write_text("a;b\n" + "1;2\n3\n" * 500)
    found = survey(spark, [Reading("a", str(tmp_path / "a"), ";", c) for c in ("UTF-8", "ISO-8859-1")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    below = plan[: plan.index("FileScan text")].rpartition("ObjectHashAggregate")[2]
    assert "Sort" not in below
    assert [(r["n_rows"], r["n_malformed"], r["column_names"]) for r in found.collect()] == [(1000, 500, ["a", "b"])] * 2


def test_thousands_of_sources_are_one_plan(spark, tmp_path):
    readings = []
    for i in range(2000):
        path = tmp_path / f"{i}.csv"
        sep, charset = (";", "UTF-8") if i % 2 else ("|", "ISO-8859-1")
        path.write_text(f"a{sep}b{sep}c{i}\n" + f"1{sep}2{sep}ã\n" * (i % 4), charset)
        readings.append(Reading(f"s{i}", str(path), sep, charset))
    start = time.monotonic()
    found = survey(spark, readings)
    assert time.monotonic() - start < 30
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    rows = found.collect()
    assert Counter(r["n_rows"] for r in rows) == Counter({k: 500 for k in range(4)})
    assert all(r["column_names"] == ["a", "b", f"c{r['source'][1:]}"] for r in rows)
    assert all(r["best"] for r in rows if r["n_rows"])


def test_headers_follow_splits_of_a_large_file(spark, tmp_path):
    path = tmp_path / "large.csv"
    path.write_text("first;second\n" + "x;y\n" * 50_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        row = only(survey(spark, [Reading("l", str(path), ";")]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (row["column_names"], row["n_rows"], row["n_malformed"]) == (["first", "second"], 50_000, 0)


LINES = st.lists(st.binary(max_size=12).map(lambda b: b.replace(b"\n", b"").replace(b"\r", b"")), max_size=40)


@settings(max_examples=15, deadline=None)
@given(LINES)
def test_byte_classes_of_random_bytes(spark, lines):
    frame = spark.createDataFrame([(bytearray(x),) for x in lines], "v binary").select(F.col("v").cast("string").alias("v"))
    columns = byte_classes(F.col("v"))
    row = frame.select(*[c.alias(n) for n, c in columns.items()]).agg(*[F.sum(n).alias(n) for n in columns]).first()
    assert (row["n_c1"] or 0) == sum(0x80 <= b < 0xA0 for x in lines for b in x)
    assert (row["n_undefined"] or 0) == sum(b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) for x in lines for b in x)
    if all(_is_utf8(x) for x in lines):
        assert not row["n_no_utf8"]


def _is_utf8(raw):
    try:
        raw.decode()
        return True
    except UnicodeDecodeError:
        return False


def test_order_of_the_rules(spark):
    cases = [(0, 5, 5, "UTF-8"), (1, 0, 0, "ISO-8859-1"), (1, 1, 0, "windows-1252"), (1, 1, 1, "ISO-8859-1")]
    frame = spark.createDataFrame(cases, "n int, c int, u int, wanted string")
    assert frame.filter(best_charset(F.col("n"), F.col("c"), F.col("u")) != F.col("wanted")).isEmpty()


def test_fields_and_names(spark):
    frame = spark.createDataFrame(
        [("a;b", ";"), ('a;"b;c";d', ";"), ("a.b|c", "|"), ("", ";"), (";;", ";"), ("x.y", ".")], "t string, s string"
    )
    assert [r[0] for r in frame.select(F.size(fields(F.col("t"), F.col("s")))).collect()] == [2, 3, 2, 1, 3, 2]
    names = spark.createDataFrame([(["A", "a", " ", '"q"', "b"],)], "n array<string>")
    assert names.select(header_names(F.col("n"))).first()[0] == ["A0", "a1", "_c2", "q", "b"]
