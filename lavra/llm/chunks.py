"""Values per chunk of text, worked out once per different chunk of a slice of texts.

Texts are cut into chunks by Arrow, equal chunks are found by its dictionary, and the values
of all chunks are laid out by one ``take``; so work in Python grows with the different chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lavra.llm.common import slices


def text_slices(
    batches: Iterator[pa.RecordBatch], column: int, limit: int
) -> Iterator[pa.RecordBatch]:
    """Rows in slices of about ``limit`` bytes of text, at least a row each; the texts as
    large strings, NULL as an empty one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for rows in batches:
        texts = pc.fill_null(rows.column(column).cast(pa.large_string()), "")
        rows = rows.set_column(column, rows.schema.names[column], texts)
        for start, end in slices(pc.binary_length(texts).to_pylist(), limit):
            part = rows.slice(start, end - start)
            held.append(part)
            size += pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if size >= limit:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def chunk_codes(
    texts: pa.Array,
    regular: pa.Array,
    split: Callable[[pa.Array], pa.Array],
    pieces: Callable[[str], Sequence[str]],
) -> tuple[pa.Array, list[str], np.ndarray, np.ndarray]:
    """Different chunks of regular texts, those of the others, the chunks of all texts as
    numbers (of the first kind, then of the second), and how many each text has.

    ``split`` cuts all regular texts at once, ``pieces`` one of the others.
    """
    lists = split(texts.filter(regular))
    words = lists.flatten().dictionary_encode()
    codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.zeros(len(texts), np.int64)
    is_regular = regular.to_numpy(zero_copy_only=False)
    counts[is_regular] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    number: dict[str, int] = {}
    places, more = [], []
    ends, first = np.cumsum(counts), len(words.dictionary)
    for i in np.flatnonzero(~is_regular).tolist():
        found = [number.setdefault(c, first + len(number)) for c in pieces(texts[i].as_py())]
        counts[i] = len(found)
        places.append(np.full(len(found), ends[i]))
        more.append(np.array(found, np.int64))
    if places:
        codes = np.insert(codes, np.concatenate(places), np.concatenate(more))
    return words.dictionary, list(number), codes, counts


def binary_values(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Values that lie in a row, of so many bytes each."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), buffers)


def laid_out(values: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the values of all codes in a row, and the end of each."""
    if not len(codes):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    taken = values.take(pa.array(codes))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[1 : len(taken) + 1]
    data = taken.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends


def ends_of(counts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each text ends, from its number of chunks and the chunks' ends."""
    return np.concatenate([[0], ends])[np.cumsum(counts)]


def joined(words: pa.Array, separator: str, group: int = 1000) -> list[str]:
    """Words put together to longer texts of ``group`` words each."""
    strings = words.to_pylist()
    return [separator.join(strings[i : i + group]) for i in range(0, len(strings), group)]


class Remembered:
    """Values of the chunks of earlier slices, at most ``entries`` and only of short chunks.

    When it is full, what the last slice used stays. Chunks are looked up all at once.
    """

    def __init__(self, entries: int, most_bytes: int):
        self.entries, self.most_bytes = entries, most_bytes
        self.chunks = pa.array([], pa.large_string())
        self.values: pa.Array | None = None

    def values_of(self, chunks: pa.Array, compute: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The value of each of these different chunks; ``compute`` gives those not known."""
        at = pc.index_in(chunks, value_set=self.chunks)
        unknown = pc.is_null(at)
        new = chunks.filter(unknown)
        values = compute(new)
        if self.values is not None:
            values = pa.concat_arrays([self.values, values])
        is_new = unknown.to_numpy(zero_copy_only=False)
        place = pc.fill_null(at, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        place[is_new] = len(self.chunks) + np.arange(len(new))
        found = values.take(pa.array(place))
        if len(self.chunks) + len(new) <= self.entries:
            kept, kept_values = pa.concat_arrays([self.chunks, new]), values
        else:
            kept, kept_values = chunks, found
        short = pc.less_equal(pc.binary_length(kept), self.most_bytes)
        self.chunks = kept.filter(short)[: self.entries]
        self.values = kept_values.filter(short)[: self.entries]
        return found
