"""Web archive files written from and read into tables of record chunks.

A payload is a sequence of chunks. The writer makes one table row per chunk, keyed by the
record's identifier and the chunk's number; a payload of several chunks becomes a record
and its ``continuation`` records, as the format has it, so no line of the archive holds
more than a chunk. Digests are carried from chunk to chunk. Equal payloads are stored
once: the record with the largest identifier is the ``response``, the others are
``revisit`` records that name it.

Archives are text files of Spark's writer, one gzip stream each and thus read in order
by one task. The reader goes through their lines, counts the bytes that each header
announces, updates the running digest, and never holds more than one line.

Payloads are text and stored in UTF-8; NULL counts as empty. Rows with a NULL identifier
revisit the largest other one of their payload, or are responses. Repeated rows are
written one by one, each with the same kind.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm.common import map_batches
from lavra.llm.components import hot_join

CHUNK_CHARS = 1 << 15
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "2000-01-01T00:00:00Z"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(key: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'record {key}')}>"


def chunks(payload: str, size: int) -> Iterator[bytes]:
    for at in range(0, max(1, len(payload)), size):
        yield payload[at : at + size].encode("utf-8", "surrogatepass")


def with_responses(
    pages: DataFrame, key: str = "page_id", payload: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Pages with the identifier of the response that holds their payload."""
    content = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).cast("long").alias("key"), F.col("url"), content.alias("payload"),
        F.sha1(content).alias("digest"),
    )
    responses = (
        rows.filter(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("key").alias("response"))
    )
    return hot_join(rows, responses, "digest", "left").select("key", "url", "payload", "response")


def chunk_table(rows: DataFrame, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per chunk of each record: identifier, number, and the record's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            ids: list[str] = []
            numbers: list[int] = []
            values: list[str] = []
            for key, url, payload, response in zip(*(c.to_pylist() for c in part.columns), strict=True):
                for number, value in _records(key, url, payload, response, chunk_chars):
                    ids.append(record_id(key))
                    numbers.append(number)
                    values.append(value)
                    if len(values) == 256:
                        yield _chunk_rows(ids, numbers, values)
                        ids, numbers, values = [], [], []
            yield _chunk_rows(ids, numbers, values)

    return map_batches(
        rows.select("key", "url", "payload", "response"),
        run,
        "record_id string, chunk int, value string",
    )


def _chunk_rows(ids: list[str], numbers: list[int], values: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.string()), pa.array(numbers, pa.int32()), pa.array(values, pa.string())],
        names=["record_id", "chunk", "value"],
    )


def _records(
    key: int | None, url: str | None, payload: str, response: int | None, size: int
) -> Iterator[tuple[int, str]]:
    digest, total = hashlib.sha1(), 0
    for part in chunks(payload, size):
        digest.update(part)
        total += len(part)
    fields = {
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join((url or "about:blank").split()),
        "WARC-Payload-Digest": f"sha1:{base32(digest.digest())}",
        "X-Key": "" if key is None else str(key),
    }
    if response is not None and response != key:
        fields |= {
            "WARC-Refers-To": record_id(response),
            "WARC-Profile": PROFILE,
            "X-Refers-To-Key": str(response),
            "X-Payload-Length": str(total),
        }
        yield 1, _record("revisit", record_id(key), fields, b"")
        return
    last = max(1, -(-len(payload) // size))
    for number, part in enumerate(chunks(payload, size), 1):
        if number > 1:
            fields = {"WARC-Date": DATE, "WARC-Segment-Origin-ID": record_id(key)}
        if last > 1:
            fields["WARC-Segment-Number"] = str(number)
            if number == last:
                fields["WARC-Segment-Total-Length"] = str(total)
        kind, name = ("response", key) if number == 1 else ("continuation", f"{key} {number}")
        yield number, _record(kind, record_id(name), fields, part)


def _record(kind: str, name: str, fields: dict[str, str], block: bytes) -> str:
    """A record as text; the writer's line end completes the closing empty line."""
    head = {"WARC-Type": kind, "WARC-Record-ID": name, **fields}
    head |= {"Content-Type": "text/html", "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.0\r\n{lines}\r\n{block.decode('utf-8', 'surrogatepass')}\r\n\r"


def write_archive(chunk_rows: DataFrame, path: str) -> None:
    """Store a chunk table as archive files below ``path``, one for each task.

    Files are never cut by a number of rows: a record's continuations stay with it."""
    chunk_rows.select("value").write.option("lineSep", "\n").option("maxRecordsPerFile", 0).text(
        path, compression="gzip"
    )


class RecordReader:
    """Puts the records of an archive together from its lines."""

    def __init__(self) -> None:
        self.head: dict[str, str] | None = None  # while a header is read
        self.left = 0  # bytes of the block to come
        self.after = 0  # lines to come after the block
        self.open: dict | None = None  # the record whose payload is read

    def line(self, text: str) -> dict | None:
        """Take one line; gives a record when it is complete."""
        if self.after:
            raw = text.encode("utf-8", "surrogatepass")
            if self.left:
                if len(raw) < self.left:
                    self._payload(raw + b"\n")
                    return None
                block, raw = raw[: self.left], raw[self.left :]
                self._payload(block)
            if raw != b"\r":
                raise ValueError("a record is longer than its header says")
            self.after -= 1
            return None if self.after else self._end()
        if self.head is None:
            if text != "WARC/1.0\r":
                raise ValueError("a record begins with another line than its version")
            self.head = {}
        elif text == "\r":
            self._begin()
        else:
            name, _, value = text.rstrip("\r").partition(": ")
            self.head[name] = value
        return None

    def _begin(self) -> None:
        head = self.head
        self.left, self.after = int(head["Content-Length"]), 2
        if head["WARC-Type"] == "continuation":
            if self.open is None or int(head["WARC-Segment-Number"]) != self.open["segment"] + 1:
                raise ValueError("a continuation without its record")
            self.open["segment"] += 1
        else:
            self.open = {"head": head, "digest": hashlib.sha1(), "bytes": 0, "segment": 1}

    def _payload(self, raw: bytes) -> None:
        self.open["digest"].update(raw)
        self.open["bytes"] += len(raw)
        self.left -= len(raw)

    def _end(self) -> dict | None:
        last, self.head = self.head, None
        if "WARC-Segment-Number" in last and "WARC-Segment-Total-Length" not in last:
            return None  # more segments follow
        record, self.open = self.open, None
        head = record["head"]
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if head["WARC-Type"] == "response" and digest != base32(record["digest"].digest()):
            raise ValueError(f"the payload of {head['WARC-Record-ID']} has another digest")
        revisit = head["WARC-Type"] == "revisit"
        return {
            "key": int(head["X-Key"]) if head["X-Key"] else None,
            "url": head["WARC-Target-URI"],
            "record_type": head["WARC-Type"],
            "payload_bytes": int(head["X-Payload-Length"]) if revisit else record["bytes"],
            "payload_digest": digest,
            "refers_to": int(head["X-Refers-To-Key"]) if revisit else None,
        }


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; a damaged archive is an error."""
    types = {
        "key": pa.int64(), "url": pa.string(), "record_type": pa.string(),
        "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RecordReader()
        for part in batches:
            done = [r for line in part.column(0) if (r := reader.line(line.as_py()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[name] for r in done], kind) for name, kind in types.items()],
                names=list(types),
            )
        if reader.head is not None or reader.open is not None:
            raise ValueError("an archive ends within a record")

    lines = spark.read.option("lineSep", "\n").text(path)
    return map_batches(
        lines,
        run,
        "key long, url string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long",
    )
