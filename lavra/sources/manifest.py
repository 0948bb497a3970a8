"""Checksums of files, and the comparison of two sets of files.

Small files are values that Spark hashes. A large file is never a value: a task reads it in
chunks through a client of its own, which is set up from the session's Hadoop settings, so
both kinds come from the same store with the same rights. Which store a file really lies in
is asked of Hadoop (a mounted path leads elsewhere). Files of a store without such a client
are refused before any work is done.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.functions.files import file_name
from lavra.sources.survey import one_slash

# A file up to this size is hashed from a binary column, a larger one as a stream.
WHOLE_FILE_BYTES = 64 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024
MOST_TASKS = 10_000

_SCHEMA = "uri string, size_bytes long, sha256 string"

#: Stores that tasks can read by themselves, and the Hadoop settings each client takes.
CLIENTS = {
    "file": (),
    "hdfs": ("fs.defaultFS", "dfs."),
    "s3": ("fs.s3a.",),
    "s3a": ("fs.s3a.",),
    "s3n": ("fs.s3a.",),
}


def refuse_unknown_stores(uris: Sequence[str]) -> None:
    """An error that names the stores whose large files no task could read."""
    unknown = sorted({urlsplit(uri).scheme for uri in uris} - set(CLIENTS))
    if unknown:
        raise ValueError(
            f"files over the limit lie in {', '.join(unknown)}, which tasks have no client "
            "for: raise whole_file_bytes (up to 2 GB) or copy them"
        )


def client_settings(spark: SparkSession, uris: Sequence[str]) -> dict[str, str]:
    """The session's Hadoop settings that the clients of these files take."""
    wanted = tuple({p for uri in uris for p in CLIENTS[urlsplit(uri).scheme]})
    if not wanted:
        return {}
    entries = spark._jsc.hadoopConfiguration().iterator()
    found = {}
    while entries.hasNext():
        entry = entries.next()
        if entry.getKey().startswith(wanted):
            found[entry.getKey()] = entry.getValue()
    return found


def s3_options(settings: dict[str, str], bucket: str) -> dict[str, object]:
    """Arguments of the object store's client; settings of the bucket go first."""

    def of(name: str) -> str | None:
        return settings.get(f"fs.s3a.bucket.{bucket}.{name}") or settings.get(f"fs.s3a.{name}")

    options: dict[str, object] = {
        "access_key": of("access.key"),
        "secret_key": of("secret.key"),
        "session_token": of("session.token"),
        "region": of("endpoint.region"),
        "force_virtual_addressing": None if of("path.style.access") != "false" else True,
    }
    endpoint = of("endpoint")
    if endpoint:
        options["endpoint_override"] = endpoint.partition("://")[2] or endpoint
        plain = endpoint.startswith("http://") or of("connection.ssl.enabled") == "false"
        options["scheme"] = "http" if plain else "https"
    return {name: value for name, value in options.items() if value is not None}


def _stream_hasher(
    chunk_bytes: int, settings: dict[str, str], buckets: dict[str, dict[str, object]]
):
    """The function tasks run. Being local, it is sent whole: executors need not have lavra."""

    def opened(uri: str):
        parts = urlsplit(uri)
        path = unquote(parts.path)
        if parts.scheme.startswith("s3"):
            store = pafs.S3FileSystem(**buckets[parts.netloc])
            return store.open_input_stream(f"{parts.netloc}{path}")
        if parts.scheme == "hdfs":
            store = pafs.HadoopFileSystem(
                f"hdfs://{parts.hostname}" if parts.hostname else "default",
                parts.port or 0,
                extra_conf=settings,
            )
            return store.open_input_stream(path)
        store, name = pafs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}{quote(path)}")
        return store.open_input_stream(name)

    def hash_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("uri", pa.string()), ("size_bytes", pa.int64()), ("sha256", pa.string())]
        )
        for batch in batches:
            for task in batch.to_pylist():
                for file in task["files"]:
                    digest, size = hashlib.sha256(), 0
                    with opened(file["located"]) as stream:
                        while chunk := stream.read(chunk_bytes):
                            digest.update(chunk)
                            size += len(chunk)
                    row = {"uri": file["uri"], "size_bytes": size, "sha256": digest.hexdigest().upper()}
                    yield pa.RecordBatch.from_pylist([row], schema=schema)

    return hash_streams


def dealt_by_size(sizes: Sequence[tuple[str, int]], most: int = MOST_TASKS) -> list[list[str]]:
    """Files of each task: the largest first, each to the task with the fewest bytes so far."""
    tasks = min(len(sizes), most)
    heap = [(0, task) for task in range(tasks)]
    files: list[list[str]] = [[] for _ in range(tasks)]
    for name, size in sorted(sizes, key=lambda item: (-item[1], item[0])):
        load, task = heapq.heappop(heap)
        files[task].append(name)
        heapq.heappush(heap, (load + size, task))
    return files


def _located(spark: SparkSession, uri: str) -> str:
    """Where a file lies in truth: behind a mounted path, say."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.resolvePath(path).toUri().toString()


def file_manifest(
    spark: SparkSession,
    paths: str | Sequence[str],
    pattern: str | None = None,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> DataFrame:
    """Name, size and SHA-256 (capital hex) of each file.

    Small files are hashed by Spark's own function. A file over the limit never
    becomes a value: tasks read it in chunks. Large files are dealt out by their size.
    """
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    files = reader.load(paths)
    names = files.inputFiles()
    uri, size = F.col("_metadata.file_path").alias("uri"), F.col("length").alias("size_bytes")
    hashed = files.filter(F.col("length") <= whole_file_bytes).select(
        one_slash(uri).alias("uri"), size, F.upper(F.sha2("content", 256)).alias("sha256")
    )
    # Names and sizes of the large ones; no content is read for them.
    large = files.filter(F.col("length") > whole_file_bytes).select(uri, size).collect()
    if large:
        hashed = hashed.unionByName(_hash_large(spark, [(r["uri"], r["size_bytes"]) for r in large]))
    # Spark's scan passes over files of no bytes; its listing has them.
    listed = spark.createDataFrame([(name,) for name in names], "uri string")
    listed = listed.select(one_slash(F.col("uri")).alias("uri"))
    return listed.join(hashed, "uri", "left").select(
        file_name(F.element_at(F.split("uri", "/"), -1)).alias("file"),
        F.coalesce("size_bytes", F.lit(0)).cast("long").alias("size_bytes"),
        F.coalesce("sha256", F.upper(F.sha2(F.lit(b""), 256))).alias("sha256"),
    )


def _hash_large(spark: SparkSession, sizes: Sequence[tuple[str, int]]) -> DataFrame:
    located = {uri: _located(spark, uri) for uri, _ in sizes}
    refuse_unknown_stores(list(located.values()))
    settings = client_settings(spark, list(located.values()))
    parts = [urlsplit(uri) for uri in located.values()]
    buckets = {p.netloc: s3_options(settings, p.netloc) for p in parts if p.scheme[:2] == "s3"}
    tasks = [
        (task, [(uri, located[uri]) for uri in names])
        for task, names in enumerate(dealt_by_size(sizes))
    ]
    table = spark.createDataFrame(tasks, "task int, files array<struct<uri:string,located:string>>")
    # One row per task, in ranges of one; a number given here stays, else adaptive execution
    # would see a few short rows and give all files to one task.
    return (
        table.repartitionByRange(len(tasks), "task")
        .mapInArrow(_stream_hasher(CHUNK_BYTES, settings, buckets), _SCHEMA)
        .select(one_slash(F.col("uri")).alias("uri"), "size_bytes", "sha256")
    )


def compare_manifests(source: DataFrame, target: DataFrame) -> DataFrame:
    """Per file the hash on both sides and whether they agree.

    A file on one side only is listed with a NULL hash, as not identical.
    """
    left = source.select("file", F.col("sha256").alias("source_sha256"))
    right = target.select("file", F.col("sha256").alias("target_sha256"))
    return left.join(right, "file", "full").withColumn(
        "identical", F.equal_null("source_sha256", "target_sha256")
    )
