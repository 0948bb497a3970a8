"""Exact encoding with a merge-type piece vocabulary, and decoding.

The ids are those of merging the best-scored adjacent pair again and again, found without
merging the text: an Aho-Corasick automaton lists the pieces at every place, longest
first; a piece may follow another if merging the two pieces' own text gives the two back
(remembered per pair); a place from which no piece leads on is marked in a bit field, and
the search steps back and takes the next shorter piece. A sequence of pairwise compatible
pieces is the one that merging gives, so the search ends with the exact encoding, in time
linear in the text. Characters that no piece holds become byte pieces.

White space separates: no piece holds a separator after another character (checked when
the model is read), so a text is encoded chunk by chunk, and short chunks are remembered
in a table of bounded size.

NULL counts as empty; an empty text has no ids and decodes to an empty text.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from lavra.llm.common import Memo, map_batches

SPACE = "▁"
CACHE_ENTRIES = 600_000
PAIR_ENTRIES = 1_000_000
CACHED_CHARS = 48

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceEncoder:
    """Encoder and decoder of one model file's content."""

    def __init__(self, model: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.decoded: list[str] = []
        for i in range(library.get_piece_size()):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                # Bytes of longer characters are escaped until they are put together.
                value = int(piece[3:5], 16)
                self.decoded.append(chr(value if value < 128 else 0xDC00 + value))
            elif library.is_control(i) or library.is_unknown(i) or library.is_unused(i):
                self.decoded.append("" if library.is_control(i) else " ⁇ ")
            else:
                self.pieces[piece] = i
                self.score[piece] = library.get_score(i)
                self.decoded.append(piece.replace(SPACE, " "))
        self.text_of = {i: piece for piece, i in self.pieces.items()}
        self.alphabet = {c for piece in self.pieces for c in piece}
        self.unknown = library.unk_id()
        self.as_text = [str(i) for i in range(library.get_piece_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.pieces):
            raise ValueError("a piece holds a separator after another character")
        cut = "" if "\n" in self.alphabet else "\n"
        self.chunk = re.compile(f"{SPACE}*[^{SPACE}{cut}]+|{SPACE}+|{cut or '(?!)'}")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            if self.merged(piece) == [piece]:  # others are never a result of merging
                self.automaton.add_word(piece, (len(piece) - 1, i))
        self.automaton.make_automaton()
        self.length = [0] * len(self.decoded)
        self.shorter = [-1] * len(self.decoded)  # the longest piece that begins a piece
        for piece, i in self.pieces.items():
            self.length[i] = len(piece)
            self.shorter[i] = next(
                (
                    self.pieces[piece[:k]]
                    for k in range(len(piece) - 1, 0, -1)
                    if piece[:k] in self.automaton
                ),
                -1,
            )
        self.compatible: dict[int, bool] = {}
        self.memo = Memo(CACHE_ENTRIES, CACHED_CHARS)

    def merged(self, text: str) -> list[str]:
        """Plain merging; for short texts."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        a, b = self.text_of[left], self.text_of[right]
        known = self.merged(a + b) == [a, b]
        if len(self.compatible) >= PAIR_ENTRIES:
            self.compatible.clear()
        self.compatible[left << 20 | right] = known
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text of known characters, by backtracking."""
        n = len(text)
        longest = [0] * n
        for last, (before, piece) in self.automaton.iter(text):
            longest[last - before] = piece  # later ends: longer pieces
        length, shorter, compatible = self.length, self.shorter, self.compatible
        dead = bytearray(n // 8 + 1)
        ids: list[int] = []
        at, previous, piece = 0, -1, longest[0]
        while True:
            end = at + length[piece]
            fits = not dead[end >> 3] >> (end & 7) & 1
            if fits and previous >= 0:
                fits = compatible.get(previous << 20 | piece)
                if fits is None:
                    fits = self.may_follow(previous, piece)
            if fits:
                ids.append(piece)
                if end == n:
                    return ids
                at, previous, piece = end, piece, longest[end]
                continue
            piece = shorter[piece]
            while piece < 0:  # no way on from here: back to the piece before
                dead[at >> 3] |= 1 << (at & 7)
                taken = ids.pop()
                at -= length[taken]
                previous = ids[-1] if ids else -1
                piece = shorter[taken]

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        if self.alphabet.issuperset(chunk):
            return tuple(self._known(chunk))
        ids: list[int] = []
        start = 0
        for i, char in enumerate(chunk):
            if char not in self.alphabet:
                if i > start:
                    ids += self._known(chunk[start:i])
                raw = char.encode()
                ids += [self.bytes[b] for b in raw] if self.bytes else [self.unknown]
                start = i + 1
        if start < len(chunk):
            ids += self._known(chunk[start:])
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        chunks = self.chunk.findall(SPACE + text.replace(" ", SPACE))
        return list(chain.from_iterable(self.memo.values(chunks, self._chunks)))

    def _chunks(self, chunks: list[str]) -> list[tuple[int, ...]]:
        return [self._chunk(chunk) for chunk in chunks]

    def decode(self, ids: list[int]) -> str:
        text = "".join(map(self.decoded.__getitem__, ids))
        try:
            text.encode()
        except UnicodeEncodeError:  # bytes that are put together to characters here
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "each_byte")
        return text.removeprefix(" ") if ids and ids[0] in self.text_of else text


_encoders: dict[bytes, PieceEncoder] = {}


def encoder(model: bytes) -> PieceEncoder:
    digest = hashlib.sha256(model).digest()
    if digest not in _encoders:
        _encoders[digest] = PieceEncoder(model)
    return _encoders[digest]


def encode_pieces(
    frame: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", ids: bool = True
) -> DataFrame:
    """Number of ids, digests of the ids and of the decoded text; the ids if asked for.

    The model file is read by the driver and sent to the tasks.
    """
    model = frame.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())
    kind = frame.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(model.value)
        for rows in batches:
            counts, encoded, decoded, lists = [], [], [], []
            for value in rows.column(1):
                found = codec.encode(value.as_py() or "")
                counts.append(len(found))
                joined = ",".join(map(codec.as_text.__getitem__, found))
                encoded.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(found).encode()).hexdigest())
                if ids:
                    lists.append(found)
            columns = [
                rows.column(0),
                pa.array(counts, pa.int64()),
                pa.array(encoded, pa.string()),
                pa.array(decoded, pa.string()),
            ]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(frame.select(key, text), run, schema + (", ids array<int>" if ids else ""))
