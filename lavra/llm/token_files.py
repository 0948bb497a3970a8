"""Files of token ids: ranks by frequency in whole bytes, read with numpy.

A corpus becomes a folder with ``ranks`` (one line per rank from 0 up: the id; the commonest
id first, equal counts by id) and ``shards``, whose files in the order of their names hold
the texts in ascending order of their identifier. A file is a sequence of blocks, each ended
by a line feed. All numbers are little-endian:

    magic ``TIDB``, then as 32 bits: shard, number of documents, number of ids, bytes of data,
    CRC-32 of all that follows the header; as 64 bits: ids and documents of the shard before
    this block; as 32 bits: pieces of the first document in earlier blocks, 1 if the last
    document goes on in the next block
    identifiers (64 bits each), 1 byte each that tells whether there is one, ids of each (32 bits)
    control bytes: 2 bits per id, the lowest first, tell how many bytes it has less one
    data bytes: the ranks

Only a text of more ids than a block holds is cut, so blocks and files stay small. The files
are written by Spark's text writer (its line feed is the end of a block) and read by its
binary reader, so they can lie in any store that Spark reaches.

Order is that of a range partitioning by identifier and place of the row, so a third of all
rows may have one identifier. A text's place in the whole corpus is its place in its shard
plus the ids of earlier shards.

NULL counts as an empty text, which has its end id only. Rows without an identifier come
first; repeated rows are all written. Identifiers are whole numbers.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lavra.llm.chunks import Remembered, binary_values, chunk_codes, ends_of, joined, laid_out, text_slices
from lavra.llm.common import map_batches, stored
from lavra.session import scratch_path

END_ID = 2
BLOCK_IDS = 1 << 17
BLOCKS_PER_FILE = 64
SHARD_IDS = 1 << 23
MOST_SHARDS = 99_999
CACHE_ENTRIES = 300_000
CACHED_BYTES = 64
SLICE_BYTES = 4 << 20
TEXTS_AT_ONCE = 64
MAGIC = b"TIDB"
HEADER = struct.Struct("<4sIIIIIQQII")

#: ASCII less the separators that only some take for white space, and the precomposed
#: letters of Latin-1: there, lowering letters first and cutting at white space is what
#: the tokenizer does itself.
UNUSUAL = "[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]"
LAST_MARK = ("([a-zß-öø-ÿ])([.,])([ \n]|$)", r"\1 \2\3")
PLAIN_WORD = "^[a-zß-öø-ÿ]+$"
WIDTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.uint8)


class BatchTokenizer:
    """Ids of many texts at once, put together from the ids of their different words."""

    def __init__(self, content: bytes):
        # A task has one core: each thread of the library would keep memory of its own, which
        # stays with the process for all later stages.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.remembered = Remembered(CACHE_ENTRIES, CACHED_BYTES)
        self.ids = self.tokenizer.get_vocab_size()
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Looked for before letters are lowered, so texts that may hold one stay whole.
        self.added = [token.content.lower() for token in added if token.content]
        suffix = self.tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError("the vocabulary does not mark the ends of words")
        self.ends_word = np.zeros(self.ids, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith(suffix)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's end."""
        texts = texts.cast(pa.large_string())
        lowered = pc.utf8_lower(texts)
        regular = pc.invert(pc.match_substring_regex(texts, UNUSUAL))
        for content in self.added:
            regular = pc.and_not(regular, pc.match_substring(lowered, content))
        del lowered
        words, whole, codes, counts = chunk_codes(texts, regular, split_words, lambda t: [t])
        values = self.remembered.values_of(words, self._of_words)
        if whole:
            ids, lengths = self._ids(whole)
            values = pa.concat_arrays([values, binary_values(ids.view(np.uint8), 4 * lengths)])
        data, ends = laid_out(values, codes)
        return data.view("<u4"), ends_of(counts, ends) // 4

    def _of_words(self, words: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(words, PLAIN_WORD)
        is_plain = plain.to_numpy(zero_copy_only=False)
        # A plain word is one word to the tokenizer, so its last id tells where it ends.
        ids = self._ids(joined(words.filter(plain), " "))[0]
        lengths = np.diff(np.flatnonzero(self.ends_word[ids]) + 1, prepend=0)
        if len(lengths) != is_plain.sum():
            raise RuntimeError("words do not end where they should")
        more, more_lengths = self._ids(words.filter(pc.invert(plain)).to_pylist())
        values = binary_values(
            np.concatenate([ids, more]).view(np.uint8), 4 * np.concatenate([lengths, more_lengths])
        )
        place = np.empty(len(words), np.int64)
        place[np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])] = np.arange(
            len(words)
        )
        return values.take(pa.array(place))

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = []
        for i in range(0, len(texts), TEXTS_AT_ONCE):
            found = self.tokenizer.encode_batch_fast(
                texts[i : i + TEXTS_AT_ONCE], add_special_tokens=False
            )
            lists += [np.array(e.ids, "<u4") for e in found]
        lengths = np.array([len(ids) for ids in lists], np.int64)
        return np.concatenate([np.zeros(0, "<u4"), *lists]), lengths


def split_words(texts: pa.Array) -> pa.Array:
    """Lowered words; a point or comma that ends one is a word, so that fewer differ."""
    lowered = pc.utf8_lower(texts)
    return pc.utf8_split_whitespace(pc.replace_substring_regex(lowered, *LAST_MARK))


_tokenizers: dict[int, BatchTokenizer] = {}


def batch_tokenizer(content: bytes) -> BatchTokenizer:
    key = hash(content)
    if key not in _tokenizers:
        _tokenizers[key] = BatchTokenizer(content)
    return _tokenizers[key]


def encode_texts(
    frame: DataFrame, vocabulary_file: str, key: str, text: str, end_id: int = END_ID
) -> DataFrame:
    """(key, task, row, n_tokens, ids): ids with the end id, as 32 or 16 bits in binary."""
    if not isinstance(frame.schema[key].dataType, T.IntegralType):
        raise TypeError(f"{key} is no whole number")
    content = frame.sparkSession.sparkContext.broadcast(Path(vocabulary_file).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = batch_tokenizer(content.value)
        kind = id_type(max(tokenizer.ids, end_id + 1))
        task, row = TaskContext.get().partitionId(), 0
        for rows in text_slices(batches, 1, SLICE_BYTES):
            ids, ends = tokenizer.encode(rows.column(1))
            ids = np.insert(ids.astype(kind), ends, end_id)
            n = rows.num_rows
            lengths = np.diff(ends, prepend=0) + 1
            binary = binary_values(ids.view(np.uint8), lengths * np.dtype(kind).itemsize)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).cast(pa.int64()),
                    pa.array(np.full(n, task, np.int32)),
                    pa.array(np.arange(row, row + n, dtype=np.int64)),
                    pa.array(lengths),
                    binary.cast(pa.binary()),
                ],
                names=["key", "task", "row", "n_tokens", "ids"],
            )
            row += n

    return map_batches(
        frame.select(key, text), run, "key long, task int, row long, n_tokens long, ids binary"
    )


def id_type(ids: int) -> str:
    return "<u2" if ids <= 1 << 16 else "<u4"


def id_counts(encoded: DataFrame, ids: int) -> np.ndarray:
    """How often each id of the vocabulary occurs; counted per task first."""
    kind = id_type(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ids, np.int64)
        for rows in batches:
            _, ends, data = rows.column(0).buffers()
            if data:
                last = np.frombuffer(ends, np.int32)[len(rows.column(0))]
                total += np.bincount(np.frombuffer(data[:last], kind), minlength=ids)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["id", "n"]
        )

    counts = np.zeros(ids, np.int64)
    per_task = map_batches(encoded.select("ids"), run, "id int, n long")
    for row in per_task.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def rank_bytes(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    extra = (ranks > 0xFF).astype(np.uint8)
    extra += ranks > 0xFFFF
    extra += ranks > 0xFFFFFF
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = extra
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    ends = np.cumsum(extra, dtype=np.int64) + np.arange(1, len(ranks) + 1)
    data = np.zeros(int(ends[-1]) if len(ranks) else 0, np.uint8)
    at = ends - extra - 1
    data[at] = ranks & 0xFF
    for k in (1, 2, 3):
        longer = np.flatnonzero(extra >= k)
        if not len(longer):
            break
        data[at[longer] + k] = ranks[longer] >> 8 * k & 0xFF
    return control.tobytes(), data.tobytes()


def ranks_of(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ranks back: widths of four ids per control byte from a table."""
    widths = WIDTHS[control].ravel()[:n]
    ends = np.cumsum(widths, dtype=np.int64)
    if len(data) != (int(ends[-1]) if n else 0):
        raise ValueError("control bytes and data bytes do not agree")
    at = ends - widths
    ranks = data[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(widths > k)
        if not len(longer):
            break
        ranks[longer] |= data[at[longer] + k].astype(np.uint32) << 8 * k
    return ranks


class BlockWriter:
    """Blocks of one shard from documents in order."""

    def __init__(self, shard: int, rank_of: np.ndarray, block_ids: int):
        self.shard, self.rank_of, self.block_ids = shard, rank_of, block_ids
        self.ids_before = self.docs_before = 0
        self._clear()

    def _clear(self) -> None:
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.parts: list[np.ndarray] = []
        self.n = self.first_piece = 0

    def _block(self, goes_on: bool = False) -> bytes:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, "<u4")
        control, data = rank_bytes(self.rank_of[ids])
        keys = np.array([0 if k is None else k for k in self.keys], "<i8")
        known = np.array([k is not None for k in self.keys], np.uint8)
        body = b"".join(
            [keys.tobytes(), known.tobytes(), np.array(self.counts, "<u4").tobytes(), control, data]
        )
        header = HEADER.pack(
            MAGIC, self.shard, len(self.keys), len(ids), len(data), zlib.crc32(body),
            self.ids_before, self.docs_before, self.first_piece, goes_on,
        )
        self.ids_before += len(ids)
        self.docs_before += len(self.keys) - goes_on
        self._clear()
        return header + body

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[bytes]:
        if self.keys and self.n + len(ids) > self.block_ids:
            yield self._block()
        piece = 0
        while len(ids) > self.block_ids:
            self._take(key, ids[: self.block_ids])
            yield self._block(goes_on=True)
            ids, piece = ids[self.block_ids :], piece + 1
            self.first_piece = piece
        self._take(key, ids)

    def _take(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.counts.append(len(ids))
        self.parts.append(ids)
        self.n += len(ids)

    def rest(self) -> Iterator[bytes]:
        if self.keys:
            yield self._block()


def write_token_files(
    frame: DataFrame,
    vocabulary_file: str,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    shard_ids: int = SHARD_IDS,
    blocks_per_file: int = BLOCKS_PER_FILE,
) -> None:
    """Encode all texts and write the files. The encoded texts are kept in the shared folder
    between counting and writing; files bear at most ``blocks_per_file`` blocks."""
    spark = frame.sparkSession
    encoded = stored(encode_texts(frame, vocabulary_file, key, text, end_id), "token-ids")
    size = Tokenizer.from_file(vocabulary_file).get_vocab_size()
    ids = max(size, end_id + 1)
    kind = id_type(ids)
    counts = id_counts(encoded, ids)
    order = np.lexsort((np.arange(ids), -counts))
    rank_of = np.empty(ids, np.uint32)
    rank_of[order] = np.arange(ids, dtype=np.uint32)
    lines = [(rank, str(i)) for rank, i in enumerate(order.tolist())]
    spark.createDataFrame(lines, "rank int, id string").coalesce(1).sortWithinPartitions(
        "rank"
    ).select("id").write.text(f"{path}/ranks")
    shards = int(min(MOST_SHARDS, max(1, -(-int(counts.sum()) // shard_ids))))
    table = spark.sparkContext.broadcast(rank_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BlockWriter(TaskContext.get().partitionId(), table.value, block_ids)

        def batch(blocks: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["block"])

        for rows in batches:
            for name, value in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                for block in writer.add(name, np.frombuffer(value.as_buffer(), kind)):
                    yield batch([block])
        yield batch(list(writer.rest()))

    place = ["key", "task", "row"]
    ordered = encoded.repartitionByRange(shards, *place).sortWithinPartitions(*place)
    blocks = map_batches(ordered.select("key", "ids"), run, "block binary")
    blocks.select(F.col("block").cast("string")).write.option(
        "maxRecordsPerFile", blocks_per_file
    ).text(f"{path}/shards")


def blocks_in(content: memoryview, id_of: np.ndarray) -> Iterator[tuple]:
    """(header, identifiers, ids per document, ids) of each block of a file."""
    at = 0
    while at < len(content):
        header = HEADER.unpack_from(content, at)
        magic, _, docs, n, size, crc = header[:6]
        if magic != MAGIC:
            raise ValueError("no block begins here")
        at += HEADER.size
        controls = -(-n // 4)
        body = content[at : at + 13 * docs + controls + size]
        at += len(body)
        if zlib.crc32(body) != crc or bytes(content[at : at + 1]) != b"\n":
            raise ValueError("a block is damaged")
        at += 1
        keys = np.frombuffer(body, "<i8", docs)
        known = np.frombuffer(body, np.uint8, docs, 8 * docs)
        counts = np.frombuffer(body, "<u4", docs, 9 * docs)
        control = np.frombuffer(body, np.uint8, controls, 13 * docs)
        data = np.frombuffer(body, np.uint8, size, 13 * docs + controls)
        names = pa.array(keys, mask=known == 0)
        yield header, names, counts, id_of[ranks_of(control, data, n)]


def read_token_files(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """Pieces of documents: key, shard, place of the document in the shard (doc), piece,
    last (no more pieces), start in the shard, n_tokens, ids_crc32, and the ids if asked for.

    A document has several pieces only if it is longer than a block.
    """
    lines = spark.read.text(f"{path}/ranks", wholetext=True).collect()
    order = [int(i) for row in lines for i in row[0].split()]
    table = spark.sparkContext.broadcast(np.array(order, "<u4"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for value in rows.column(0):
                for header, names, counts, found in blocks_in(
                    memoryview(value.as_buffer()), table.value
                ):
                    _, shard, docs, _, _, _, before, number, piece, goes_on = header
                    ends = np.cumsum(counts, dtype=np.int64)
                    view, starts = memoryview(found).cast("B"), ends - counts
                    crcs = [
                        zlib.crc32(view[4 * a : 4 * b])
                        for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                    ]
                    pieces, last = np.zeros(docs, np.int32), np.ones(docs, bool)
                    pieces[:1], last[-1:] = piece, not goes_on
                    columns = {
                        "key": names,
                        "shard": pa.array(np.full(docs, shard, np.int32)),
                        "doc": pa.array(number + np.arange(docs, dtype=np.int64)),
                        "piece": pa.array(pieces),
                        "last": pa.array(last),
                        "start": pa.array(before + starts),
                        "n_tokens": pa.array(counts.astype(np.int64)),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                    if ids:
                        columns["ids"] = pa.array(
                            [found[a:b] for a, b in zip(starts, ends, strict=True)],
                            pa.list_(pa.int32()),
                        )
                    yield pa.RecordBatch.from_pydict(columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    schema = (
        "key long, shard int, doc long, piece int, last boolean, start long, "
        "n_tokens long, ids_crc32 long"
    )
    content = files.load(f"{path}/shards").select("content")
    return map_batches(content, run, schema + (", ids array<int>" if ids else ""))


def joined_crc(parts: list[tuple[int, int, int]]) -> tuple[int, int]:
    """Ids and CRC-32 of pieces (number, ids, CRC-32) put together.

    The CRC of a text followed by zeros and that of the zeros tell what the first part adds.
    """
    total = crc = 0
    for _, n, part in sorted(parts):
        zeros = bytes(4 * n)
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ part
        total += n
    return total, crc


def token_digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document, read from the files: key, start in the whole corpus, n_tokens, ids_crc32."""
    pieces = stored(read_token_files(spark, path, ids=False), "token-pieces")
    ends = pieces.groupBy("shard").agg(F.max(F.col("start") + F.col("n_tokens")).alias("n"))
    base, bases = 0, []
    for row in sorted(ends.collect()):  # one row per shard, of which there are MOST_SHARDS
        bases.append((row["shard"], base))
        base += row["n"]
    whole = pieces.filter("piece = 0 AND last").select(
        "key", "shard", "start", "n_tokens", "ids_crc32"
    )
    cut = (
        pieces.filter("NOT (piece = 0 AND last)")
        .groupBy("shard", "doc")
        .agg(
            F.max("key").alias("key"),
            F.min("start").alias("start"),
            F.collect_list(F.struct("piece", "n_tokens", "ids_crc32")).alias("parts"),
        )
        .select("key", "shard", "start", "parts")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [joined_crc([tuple(p.values()) for p in v]) for v in rows.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], *(pa.array([f[k] for f in found], pa.int64()) for k in (0, 1))],
                names=["key", "shard", "start", "n_tokens", "ids_crc32"],
            )

    schema = "key long, shard int, start long, n_tokens long, ids_crc32 long"
    every = whole.unionByName(map_batches(cut, join, schema))
    offsets = spark.createDataFrame(bases, "shard int, base long")
    return every.join(F.broadcast(offsets), "shard").select(
        F.col("key").alias(key),
        (F.col("start") + F.col("base")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def round_trip(
    frame: DataFrame, vocabulary_file: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write a corpus to the shared folder and give the digests of what is read back."""
    path = scratch_path(frame.sparkSession, "token-files")
    write_token_files(frame, vocabulary_file, path, key, text)
    return token_digests(frame.sparkSession, path, key)
