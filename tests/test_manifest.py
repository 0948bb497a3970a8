"""Large files: which store they lie in, who reads them, and how they are dealt out."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from lavra import sources as src
from lavra.sources import manifest as module


def test_the_largest_files_get_tasks_of_their_own():
    sizes = [("a", 100), ("b", 60), ("c", 50), ("d", 40), ("e", 10), ("f", 0)]
    dealt = module.dealt_by_size(sizes, 3)
    loads = sorted(sum(dict(sizes)[n] for n in names) for names in dealt)
    assert sorted(n for names in dealt for n in names) == list("abcdef") and loads == [70, 90, 100]
    assert module.dealt_by_size(sizes, 100) == [["a"], ["b"], ["c"], ["d"], ["e"], ["f"]]
    assert module.dealt_by_size([], 3) == []


def test_each_task_reads_its_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "MOST_TASKS", 10_000)
    for i in range(9):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * (i + 1) * 1000)
    sizes = [(f"file:{tmp_path}/{i}.bin", (i + 1) * 1000) for i in range(9)]
    hashed = module._hash_large(spark, sizes).withColumn("p", F.spark_partition_id())
    rows = hashed.collect()
    assert len({r["p"] for r in rows}) == 9  # no two large files share a task
    for r in rows:
        content = open(r["uri"].removeprefix("file:"), "rb").read()
        assert r["sha256"] == hashlib.sha256(content).hexdigest().upper()
        assert r["size_bytes"] == len(content)


def test_stores_without_a_client_are_refused():
    with pytest.raises(ValueError, match="abfss, gs"):
        module.refuse_unknown_stores(["file:/a", "gs://b/c", "abfss://d/e"])
    module.refuse_unknown_stores(["file:/a", "s3a://b/c", "hdfs://n:1/d"])


def test_a_refusal_comes_before_any_work(spark, tmp_path, monkeypatch):
    (tmp_path / "a.bin").write_bytes(b"12345")
    monkeypatch.setattr(module, "_located", lambda spark, uri: uri.replace("file:", "wasb:"))
    hashed = []
    monkeypatch.setattr(module, "_stream_hasher", lambda *a: hashed.append(a))
    with pytest.raises(ValueError, match="wasb.*whole_file_bytes"):
        src.file_manifest(spark, str(tmp_path), whole_file_bytes=0)
    assert not hashed
    # Below the limit Spark reads them itself, whatever the store.
    assert src.file_manifest(spark, str(tmp_path)).count() == 1


@pytest.mark.parametrize("limit", [0, 4, 10**6])
def test_mounted_paths_lead_to_the_store_behind_them(spark, tmp_path, limit):
    """A path that only Hadoop can resolve gives the same manifest on both sides of the limit."""
    (tmp_path / "a b.bin").write_bytes(b"12345")
    (tmp_path / "c.bin").write_bytes(b"x")
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.manifest.link./data", f"file://{tmp_path}")
    found = src.file_manifest(spark, "viewfs://manifest/data", whole_file_bytes=limit)
    assert {(r["file"], r["size_bytes"], r["sha256"]) for r in found.collect()} == {
        ("a b.bin", 5, hashlib.sha256(b"12345").hexdigest().upper()),
        ("c.bin", 1, hashlib.sha256(b"x").hexdigest().upper()),
    }


def test_clients_get_the_settings_of_the_session(spark):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.s3a.access.key", "all")
    conf.set("fs.s3a.secret.key", "hidden")
    conf.set("fs.s3a.bucket.special.access.key", "own")
    conf.set("fs.s3a.endpoint", "http://store:9000")
    try:
        assert module.client_settings(spark, ["file:/a"]) == {}
        settings = module.client_settings(spark, ["s3a://special/a"])
    finally:
        for name in ("fs.s3a.access.key", "fs.s3a.secret.key", "fs.s3a.bucket.special.access.key", "fs.s3a.endpoint"):
            conf.unset(name)
    own = module.s3_options(settings, "special")
    assert (own["access_key"], own["secret_key"]) == ("own", "hidden")
    assert (own["endpoint_override"], own["scheme"]) == ("store:9000", "http")
    assert module.s3_options(settings, "other")["access_key"] == "all"
    assert module.s3_options({}, "other") == {}
    assert all(name.startswith("fs.s3a.") for name in settings)
