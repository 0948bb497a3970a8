"""Alignment of the tokens that two tokenizers make of the same text.

Both token sequences cut the same bytes (a space and the text), so every token is an interval
and tokens of the two that share bytes overlap. Groups are the components of that relation;
they end where tokens of both end. They are found by pointer jumping: every token points to
the farthest-right token it overlaps, a token at a shared end to the one of the first
tokenizer that ends there, and that one to itself. Replacing each pointer by the pointer of
its target, for all tokens at once, doubles the steps it stands for until every token points
to the last of its component, whose number is the group's.

A space after a printable character begins a token in both tokenizers, whatever went before.
Texts are cut there, different chunks of a slice of texts are aligned together, and texts are
put together from their chunks. That tokens of both end where a chunk does is checked.

Linked id pairs (all pairs within a group) are kept per document with their number. How many
documents hold a pair is counted by a shuffle. The commonest pairs, a table of at most
``MOST_PAIRS``, are looked up in tasks; the others, each of which few documents hold, by a join.

NULL and empty texts have no tokens, nor have texts that the tokens of either do not give back.
Repeated rows are documents of their own, also to the counts. A group of more than ``LARGE``
links is counted by its different ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lavra.llm.chunks import Remembered, binary_values, chunk_codes, ends_of, joined, laid_out, text_slices
from lavra.llm.common import map_batches, stored
from lavra.llm.components import hot_join

SPACE = "▁"
SLICE_BYTES = 1 << 20
CACHE_ENTRIES = 100_000
CACHED_BYTES = 64
MOST_PAIRS = 2_000_000
HELD_PAIRS = 4_000_000
LARGE = 4096
#: Characters after which a space begins a token: printable, and no white space.
BEFORE_CUT = "!-~¡-ᙿ"
CUT = re.compile(f"(?<=[{BEFORE_CUT}])(?= .)", re.S)
#: Texts with another space, a space at an end, or a character that stands for a space.
IRREGULAR = f"^ |^$|[^{BEFORE_CUT}] | $|{SPACE}"


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the others as
    characters from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def lengths_to(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values up to each end, less those up to the end before."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[ends], prepend=0)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each length in turn."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def last_of_component(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each token, those of the first tokenizer before those of the second, the last token
    of its component; both sequences end at the same byte."""
    other = np.searchsorted(b_ends, a_ends)
    own = np.arange(len(a_ends))
    shared = b_ends[other] == a_ends
    pointer = np.concatenate(
        [np.where(shared, own, len(a_ends) + other), np.searchsorted(a_ends, b_ends)]
    )
    while True:
        further = pointer[pointer]
        if (further == pointer).all():
            return pointer
        pointer = further


class Aligner:
    """Both tokenizers, with the bytes of their tokens."""

    def __init__(self, vocabulary: bytes, model: bytes):
        self.first = Tokenizer.from_str(vocabulary.decode())
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        byte = byte_of_character()
        self.a_bytes = [b""] * self.first.get_vocab_size()
        for token, i in self.first.get_vocab().items():
            known = all(c in byte for c in token)
            self.a_bytes[i] = bytes(byte[c] for c in token) if known else token.encode()
        self.b_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            is_byte = self.second.is_byte(i)
            value = bytes([int(piece[3:5], 16)]) if is_byte else piece.replace(SPACE, " ").encode()
            self.b_bytes.append(value)
        self.a_length = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_length = np.array([len(b) for b in self.b_bytes], np.int64)
        self.pair_type = "<u4" if self.a_length.size * self.b_length.size <= 1 << 32 else "<u8"
        self.remembered = Remembered(CACHE_ENTRIES, CACHED_BYTES)
        # Ids as text: of either tokenizer before another of its group, and as its last.
        self.written = pa.array(
            [f"{i}{mark}".encode() for n, marks in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
             for mark in marks for i in range(n)],
            pa.large_binary(),
        )

    def _encode(self, units: list[str]) -> tuple[list, list, list[bool]]:
        """Ids of both for texts that begin with a space, and whether they give it back."""
        a = [e.ids for e in self.first.encode_batch_fast(units, add_special_tokens=False)]
        b = self.second.encode([u[1:] for u in units], num_threads=1)
        good = []
        for unit, x, y in zip(units, a, b, strict=True):
            raw = unit.encode()
            good.append(
                b"".join(map(self.a_bytes.__getitem__, x)) == raw
                and b"".join(map(self.b_bytes.__getitem__, y)) == raw
            )
        return a, b, good

    def chunks(self, words: pa.Array, others: list[str]) -> tuple[pa.Array, np.ndarray]:
        """What words (each after a space) and other chunks (each with its first space)
        consist of, and whether their tokens give them back; bad chunks have no tokens."""
        found = [self.remembered.values_of(words, self._of_words)]
        fine = np.ones(len(words) + len(others), bool)
        if others:
            a, b, good = self._encode(others)
            fine[len(words) :] = good
            kept = [i for i, g in enumerate(good) if g]
            sizes = np.array([len(others[i].encode()) for i in kept], np.int64)
            ids = _flat([a[i] for i in kept]), _flat([b[i] for i in kept])
            found.append(self._aligned(*ids, sizes, np.array(good, bool)))
        return pa.concat_arrays(found), fine

    def _of_words(self, words: pa.Array) -> pa.Array:
        a, b, good = self._encode([" " + unit for unit in joined(words, " ")])
        if not all(good):
            raise RuntimeError("tokens of regular words do not give them back")
        sizes = 1 + pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        return self._aligned(_flat(a), _flat(b), sizes, np.ones(len(words), bool))

    def _aligned(
        self, a_ids: np.ndarray, b_ids: np.ndarray, sizes: np.ndarray, good: np.ndarray
    ) -> pa.StructArray:
        """Chunks from their tokens in a row and their bytes; ``good`` tells which of all
        chunks these are."""
        a_ends, b_ends = np.cumsum(self.a_length[a_ids]), np.cumsum(self.b_length[b_ids])
        chunk_ends = np.cumsum(sizes)
        for ends in (a_ends, b_ends):
            if len(sizes) and not (
                ends[-1] == chunk_ends[-1]
                and (ends[np.searchsorted(ends, chunk_ends)] == chunk_ends).all()
            ):
                raise RuntimeError("a token goes beyond its chunk")
        pointer = last_of_component(a_ends, b_ends) if len(sizes) else np.zeros(0, np.int64)
        is_last = pointer[: len(a_ids)] == np.arange(len(a_ids))
        number = np.cumsum(is_last) - 1
        a_group, b_group = number[pointer[: len(a_ids)]], number[pointer[len(a_ids) :]]
        last = np.flatnonzero(is_last)
        a_count = np.bincount(a_group, minlength=len(last))
        b_count = np.bincount(b_group, minlength=len(last))
        chunk, chunks = np.searchsorted(chunk_ends, a_ends[last]), len(sizes)
        text, text_bytes = self._written(a_ids, b_ids, a_count, b_count, chunk, chunks)
        of, codes, times = self._pairs(a_ids, b_ids, a_group, a_count, b_count, chunk)
        pairs = np.bincount(of, minlength=chunks)

        def whole(values: np.ndarray) -> np.ndarray:
            out = np.zeros(len(good), np.int64)
            out[good] = values
            return out

        def total(values: np.ndarray) -> np.ndarray:
            sums = np.zeros(chunks, np.int64)
            np.add.at(sums, chunk, values)
            return whole(sums)

        columns = {
            "n_a": pa.array(total(a_count)),
            "n_b": pa.array(total(b_count)),
            "n_groups": pa.array(whole(np.bincount(chunk, minlength=chunks))),
            "n_links": pa.array(total(a_count * b_count)),
            "text": binary_values(text, whole(text_bytes)),
            "pairs": binary_values(codes.view(np.uint8), whole(pairs) * codes.itemsize),
            "times": binary_values(times.view(np.uint8), whole(pairs) * times.itemsize),
        }
        return pa.StructArray.from_arrays(list(columns.values()), list(columns))

    def _written(self, a_ids, b_ids, a_count, b_count, chunk, chunks):
        """The groups of all chunks as text, and how many bytes each chunk has."""
        n, m = len(self.a_bytes), len(self.b_bytes)
        a_end, b_end = np.cumsum(a_count), np.cumsum(b_count)
        a_codes, b_codes = a_ids.astype(np.int64), 2 * n + b_ids.astype(np.int64)
        a_codes[a_end - 1] += n
        b_codes[b_end - 1] += m
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[ranges(a_end - a_count + b_end - b_count, a_count)] = a_codes
        order[ranges(a_end + b_end - b_count, b_count)] = b_codes
        data, ends = laid_out(self.written, order)
        if not len(a_end):
            return data, np.zeros(chunks, np.int64)
        group_bytes = np.diff(ends[a_end + b_end - 1], prepend=0)
        sizes = np.zeros(chunks, np.int64)
        np.add.at(sizes, chunk, group_bytes)
        return data, sizes

    def _pairs(self, a_ids, b_ids, a_group, a_count, b_count, chunk):
        """(chunk, pair, how often) of all links, in order of chunk and pair."""
        width = len(self.b_bytes)
        a_first, b_first = np.cumsum(a_count) - a_count, np.cumsum(b_count) - b_count
        large = a_count * b_count > LARGE
        small = ~large[a_group]
        each = np.where(small, b_count[a_group], 0)
        b = b_ids[ranges(b_first[a_group], each)].astype(np.uint64)
        code = np.repeat(a_ids, each).astype(np.uint64) * np.uint64(width) + b
        of, times = np.repeat(chunk[a_group], each), np.ones(len(code), np.int64)
        extra = []
        for g in np.flatnonzero(large).tolist():
            x, nx = np.unique(a_ids[a_first[g] : a_first[g] + a_count[g]], return_counts=True)
            y, ny = np.unique(b_ids[b_first[g] : b_first[g] + b_count[g]], return_counts=True)
            pairs = (x.astype(np.uint64)[:, None] * np.uint64(width) + y.astype(np.uint64)).ravel()
            extra.append((np.full(len(pairs), chunk[g]), pairs, np.outer(nx, ny).ravel()))
        if extra:
            of, code, times = (
                np.concatenate([x, *parts])
                for x, parts in zip((of, code, times), zip(*extra, strict=True), strict=True)
            )
        return summed(of, code.astype(self.pair_type), times)

    def documents(self, texts: pa.Array) -> dict[str, pa.Array]:
        texts = texts.cast(pa.large_string())
        regular = pc.invert(pc.match_substring_regex(texts, IRREGULAR))
        words, others, codes, counts = chunk_codes(
            texts, regular, lambda t: pc.split_pattern(t, " "), irregular_chunks
        )
        chunks, good = self.chunks(words, others)
        ends = np.cumsum(counts)
        kept = lengths_to(~good[codes], ends) == 0
        codes, counts = codes[np.repeat(kept, counts)], np.where(kept, counts, 0)
        ends = np.cumsum(counts)
        data, chunk_ends = laid_out(chunks.field("text"), codes)
        view, digests, start = memoryview(data), [], 0
        for end in ends_of(counts, chunk_ends).tolist():
            digests.append(hashlib.sha256(view[start : end - 1]).hexdigest() if end > start else "")
            start = end
        # Chunks of each document once with their number, then their pairs.
        document = np.repeat(np.arange(len(texts)), counts)
        document, chunk, often = summed(document, codes, np.ones(len(codes), np.int64))
        pairs, pair_ends = laid_out(chunks.field("pairs"), chunk)
        pairs = pairs.view(self.pair_type)
        each = np.diff(pair_ends, prepend=0) // pairs.itemsize
        times = laid_out(chunks.field("times"), chunk)[0].view("<i8") * np.repeat(often, each)
        document, pairs, times = summed(np.repeat(document, each), pairs, times)
        sizes = np.bincount(document, minlength=len(texts))

        def numbers(name: str) -> np.ndarray:
            return lengths_to(chunks.field(name).to_numpy()[codes], ends)

        return {
            "n_a": pa.array(numbers("n_a")),
            "n_b": pa.array(numbers("n_b")),
            "n_groups": pa.array(numbers("n_groups")),
            "n_links": pa.array(numbers("n_links")),
            "groups_sha256": pa.array(digests, pa.string()),
            "pairs": binary_values(pairs.view(np.uint8), sizes * pairs.itemsize).cast(pa.binary()),
            "times": binary_values(times.view(np.uint8), sizes * 8).cast(pa.binary()),
        }


def irregular_chunks(text: str) -> list[str]:
    return CUT.split(" " + text) if text else []


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.array(x, np.int64) for x in lists)])


def summed(of: np.ndarray, code: np.ndarray, times: np.ndarray):
    """Numbers of equal (of, code) added up, in their order."""
    if not len(of):
        return of, code, times
    if int(of.max()) < 1 << 31 and int(code.max()) < 1 << 32:
        key = of.astype(np.uint64) << np.uint64(32) | code.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        changes = np.diff(key[order]) != 0
    else:
        order = np.lexsort((code, of))
        changes = (np.diff(of[order]) != 0) | (np.diff(code[order]) != 0)
    first = np.concatenate([[0], np.flatnonzero(changes) + 1])
    return of[order][first], code[order][first], np.add.reduceat(times[order], first)


_aligners: dict[int, Aligner] = {}


def aligner(vocabulary: bytes, model: bytes) -> Aligner:
    key = hash((vocabulary, model))
    if key not in _aligners:
        _aligners[key] = Aligner(vocabulary, model)
    return _aligners[key]


NUMBERS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def aligned_documents(
    frame: DataFrame, vocabulary_file: str, model_file: str, key: str, text: str
) -> DataFrame:
    """key, place (a number per row), numbers, digest of the groups, linked pairs and how
    often each is linked (binary)."""
    context = frame.sparkSession.sparkContext
    files = context.broadcast((Path(vocabulary_file).read_bytes(), Path(model_file).read_bytes()))
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = aligner(*files.value)
        place = TaskContext.get().partitionId() << 40
        for rows in text_slices(batches, 1, SLICE_BYTES):
            columns = {key: rows.column(0), "place": pa.array(place + np.arange(rows.num_rows))}
            yield pa.RecordBatch.from_pydict(columns | tokenizers.documents(rows.column(1)))
            place += rows.num_rows

    schema = f"`{key}` {kind}, place long, {NUMBERS}, pairs binary, times binary"
    return map_batches(frame.select(key, text), run, schema)


def values_in(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a binary column, and where those of each row end."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[: len(column) + 1] if len(column) else np.zeros(1, np.int32)
    values = np.frombuffer(data[: int(ends[-1])], kind) if data else np.zeros(0, kind)
    return values, ends[1:].astype(np.int64) // np.dtype(kind).itemsize


def document_counts(aligned: DataFrame, kind: str) -> DataFrame:
    """(code, n): in how many documents each pair is linked; added up per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes = np.concatenate([np.zeros(0, kind), *(c for c, _ in held)])
            numbers = np.concatenate([np.zeros(0, np.int64), *(n for _, n in held)])
            _, codes, numbers = summed(np.zeros(len(codes), np.int64), codes, numbers)
            return codes, numbers

        def batch() -> pa.RecordBatch:
            codes, numbers = merged()
            return pa.RecordBatch.from_arrays(
                [pa.array(codes.astype(np.int64)), pa.array(numbers)], names=["code", "n"]
            )

        for rows in batches:
            codes, numbers = np.unique(values_in(rows.column(0), kind)[0], return_counts=True)
            held.append((codes, numbers))
            size += len(codes)
            if size > HELD_PAIRS:
                held[:] = [merged()]
                size = len(held[0][0])
                if size > HELD_PAIRS // 2:
                    yield batch()
                    held.clear()
                    size = 0
        yield batch()

    counted = map_batches(aligned.select("pairs"), run, "code long, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def align_texts(
    frame: DataFrame,
    vocabulary_file: str,
    model_file: str,
    key: str = "doc_id",
    text: str = "text",
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """Per document: key, n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose
    count is the highest of their first id's), count_sum (of all links). The count of a pair
    is the number of documents that hold it linked."""
    spark = frame.sparkSession
    small = Aligner(Path(vocabulary_file).read_bytes(), Path(model_file).read_bytes())
    kind, width, ids = small.pair_type, len(small.b_bytes), len(small.a_bytes)
    aligned = stored(aligned_documents(frame, vocabulary_file, model_file, key, text), "aligned")
    counts = stored(document_counts(aligned, kind), "pair-counts")
    best = np.zeros(ids, np.int64)
    per_id = counts.groupBy((F.expr(f"code div {width}")).alias("a")).agg(F.max("n").alias("best"))
    for row in per_id.collect():  # one row per id of the first vocabulary at most
        best[row["a"]] = row["best"]
    least = least_common(counts, most_pairs)
    table = counts.filter(F.col("n") >= least).toArrow()  # most_pairs rows at most
    codes, numbers = table["code"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(codes)
    shared = spark.sparkContext.broadcast((codes[order].astype(kind), numbers[order], best))

    def looked_up(rows: pa.RecordBatch):
        codes, ends = values_in(rows.column("pairs"), kind)
        times = values_in(rows.column("times"), "<i8")[0]
        common, n, best = shared.value
        at = np.minimum(np.searchsorted(common, codes), max(len(common) - 1, 0))
        known = common[at] == codes if len(common) else np.zeros(len(codes), bool)
        return codes, times, ends, known, n[at[known]], best

    def from_common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            codes, times, ends, known, n, best = looked_up(rows)
            total, at_best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
            total[known] = n * times[known]
            at_best[known] = np.where(n == best[codes[known] // width], times[known], 0)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-2], pa.array(lengths_to(at_best, ends)), pa.array(lengths_to(total, ends))],
                names=[*rows.schema.names[:-2], "n_best", "count_sum"],
            )

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            codes, times, ends, known, _, _ = looked_up(rows)
            places = np.repeat(rows.column("place").to_numpy(), np.diff(ends, prepend=0))[~known]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), pa.array(codes[~known].astype(np.int64)), pa.array(times[~known])],
                names=["place", "code", "times"],
            )

    documents = map_batches(
        aligned,
        from_common,
        f"`{key}` {frame.schema[key].dataType.simpleString()}, place long, {NUMBERS}, "
        "n_best long, count_sum long",
    )
    rows = map_batches(
        aligned.select("place", "pairs", "times"), rare, "place long, code long, times long"
    )
    highest = per_id.withColumnRenamed("a", "__a")
    found = hot_join(rows, counts.filter(F.col("n") < least), "code")
    found = found.join(F.broadcast(highest), F.expr(f"code div {width}") == F.col("__a"))
    sums = found.groupBy("place").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    return hot_join(documents, sums, "place", "left").select(
        key, "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def least_common(counts: DataFrame, most: int) -> int:
    """The least power of two that at most ``most`` pairs reach."""
    power = F.length(F.bin("n")) - 1
    rows = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("pairs")).collect()
    pairs = {row["power"]: row["pairs"] for row in rows}
    total, least = 0, 63
    for k in range(62, -1, -1):
        total += pairs.get(k, 0)
        if total > most:
            break
        least = k
    return 1 << least if least < 63 else (1 << 63) - 1
