"""Exact self-join of texts on the Jaccard similarity of their word n-grams.

A text's set holds the 64-bit hashes of its distinct shingles. Texts with equal sets are
one class. Every class sends the rarest shingles of its set, as many as two sets of
sufficient similarity must have some in common of (see ``spare``), to a table of postings. Classes
of like size that share so many which few classes send (or all they must share, if fewer), or one
which more do, are joined to candidate components; a shingle that many send costs as many rows as it has
members. Inside a candidate component, sets are
searched for by T-occurrence: of a set's inverted lists the long ones are put aside, the
short ones are merged, and a class in enough of them is looked up in the long lists by
binary search (DivideSkip). Classes already joined are not looked up again, as only
components are asked for.

The order of rarity only decides how many candidates there are, not the result. It comes
from counts over all texts: in how many of them shingles of each range of hashes occur.

Components of more than ``BLOCK_CLASSES`` classes or ``BLOCK_SHINGLES`` shingles may be
chains of texts that share passages by chance, and chains get longer the more texts there
are. Their classes get signatures, the parities of how many shingles fall into each of some
ranges: two sets differ in no fewer shingles than their signatures in bits. Classes that share
a sent shingle stay candidates if their signatures allow a link. Shingles that over
``CELL_CLASSES`` of them send join them as before.

Components that are still as large are cut into blocks. A few pivots are searched for in every
block; the classes linked to the best pivot are one component and need no comparing with each
other. The other classes, in blocks, are searched for in every block, one block of each
component after another. No task holds more than two blocks.

NULL and empty texts have no shingle and link with nothing; a NULL identifier counts as
absent, so its row gets the smallest identifier of its component, or NULL. Repeated rows
are members like any other.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import map_batches, release, ship, stored, stored_twice
from lavra.llm.components import FOREST_NODES, Forest, components, hot_join

SHINGLE_WORDS = 4
#: Ranges of hashes in which texts are counted, and how they are sent.
RANGES_PER_TEXT, LEAST_BITS, MOST_BITS, CHUNK_BITS = 32, 16, 25, 16
BLOCK_CLASSES = 1 << 14
BLOCK_SHINGLES = 4_000_000
PIVOTS = 4
#: Classes, of 24 bytes, whose list is sent to all tasks; a longer one is shuffled.
BROADCAST_CLASSES = 1_000_000
COMMON, COMMON_SHARE = 3, 50  # sent shingles that classes must share if few send these (see spare)
PAIRED_CLASSES = 16
CELL_CLASSES = 2048  # that send one shingle and are compared by their signatures
SIGNATURE_BITS = 1 << 13  # at most
PAIR_WORDS = 1 << 20  # of signatures that are compared at a time
PAIRS = 1 << 18
GROUPED_ROWS = 16_384
MERGE_HEAP = 256  # entries of short lists up to which a heap merges them
PROBE_COST = 0.02


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words, A-Z in lower case. Splitting bytes splits at the six ASCII
    white-space characters and no others."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words; one for all words if there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    factor = np.uint64(0x9E3779B97F4A7C15)
    value = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        value = _mixed(value * factor + words[k : len(words) - width + 1 + k])
    return value


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def shingle_counts(frame: DataFrame, text: str, width: int, bits: int) -> np.ndarray:
    """How many texts hold a shingle of each of 2^bits ranges of hashes, as four times the
    binary logarithm.

    Tasks count in an array and send it in compressed chunks; the chunks of one range are
    added up one after another. The driver gets a byte per range.
    """
    spark, chunk = frame.sparkSession, 1 << min(bits, CHUNK_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, texts = np.zeros(1 << bits, np.uint16), 0

        def rows() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(table), chunk):
                if table[i : i + chunk].any():
                    packed = zlib.compress(table[i : i + chunk].tobytes(), 1)
                    yield _chunk_row(i // chunk, packed)

        for part in batches:
            for value in part.column(0):
                found = np.unique(shingles(word_hashes(value.as_py() or ""), width))
                np.add.at(table, _range_of(found, bits), np.uint16(1))
                texts += 1
                if texts == 60_000:  # before 16 bits end
                    yield from rows()
                    table[:] = 0
                    texts = 0
        yield from rows()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for part in batches:
            for i, packed in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                counts = np.frombuffer(zlib.decompress(packed.as_py()), np.uint16)
                totals[i] = totals.get(i, 0) + counts.astype(np.int64)
        for i, total in totals.items():
            level = np.minimum(np.round(4 * np.log2(total + 1)), 255).astype(np.uint8)
            yield _chunk_row(i, level.tobytes())

    counted = map_batches(frame.select(text), count, "chunk int, counts binary")
    tasks = min((1 << bits) // chunk, int(spark.conf.get("spark.sql.shuffle.partitions")))
    levels = np.zeros(1 << bits, np.uint8)
    for row in map_batches(counted.repartition(tasks, "chunk"), add, "chunk int, counts binary").collect():
        levels[row["chunk"] * chunk : (row["chunk"] + 1) * chunk] = np.frombuffer(row["counts"], np.uint8)
    return levels


def _chunk_row(number: int, values: bytes) -> pa.RecordBatch:
    columns = [pa.array([number], pa.int32()), pa.array([values], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["chunk", "counts"])


def _range_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def spare(size):
    """How many of the shingles that a set sends any partner of its size or more sends too, if
    it has to share so many: 3, and one more for every 50."""
    return COMMON + size // COMMON_SHARE


class Rarity:
    """An order of shingles, those of few texts first; the same everywhere."""

    def __init__(self, levels: np.ndarray, width: int):
        self.levels, self.width = levels, width
        self.bits = len(levels).bit_length() - 1

    @classmethod
    def of(cls, frame: DataFrame, text: str, width: int) -> Rarity:
        """Counted over all texts, in more ranges the more texts there are."""
        bits = min(max((frame.count() * RANGES_PER_TEXT).bit_length(), LEAST_BITS), MOST_BITS)
        return cls(shingle_counts(frame, text, width, bits), width)

    def prefix(self, words: np.ndarray, least: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """The sorted set of a text's shingles, and the rarest of them that it sends: so many that
        ``spare`` of those that it shares with any partner are among them, or all."""
        keys = np.unique(shingles(words, self.width))
        share = -(-least[0] * len(keys) // least[1])  # the least overlap with any partner
        level = self.levels[_range_of(keys, self.bits)]
        return keys, keys[np.argsort(level, kind="stable")[: len(keys) - share + spare(len(keys))]]


def text_sets(
    frame: DataFrame, rarity: Rarity, key: str, text: str, least: tuple[int, int]
) -> DataFrame:
    """Identifier, size, digest of the set (NULL if empty) and the shingles it sends."""
    shared = frame.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes, digests, prefixes = [], [], []
            for value in rows.column(1):
                words = word_hashes(value.as_py() or "")
                if len(words):
                    keys, prefix = shared.value.prefix(words, least)
                    sizes.append(len(keys))
                    digests.append(xxhash.xxh3_128_hexdigest(keys.tobytes()))
                    prefixes.append(_signed(prefix))
                else:
                    sizes.append(0)
                    digests.append(None)
                    prefixes.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "prefix"],
            )

    chosen = frame.select(F.col(key).cast("long").alias("doc_id"), F.col(text))
    return map_batches(
        chosen, run, "doc_id long, n_shingles long, digest string, prefix array<long>"
    )


class Index:
    """Inverted lists over the sets of a block."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.size)
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.argsort(values, kind="stable")
        self.owner, values = owner[order], values[order]
        self.keys, self.start = np.unique(values, return_index=True)
        self.start = np.append(self.start, len(values))

    def search(self, query: np.ndarray, least: tuple[int, int], skip) -> np.ndarray:
        """Members that reach the overlap; ``skip(members)`` masks those not to look up."""
        need = -(-least[0] * len(query) // least[1])
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, query), len(self.keys) - 1)
        at = at[self.keys[at] == query]
        if len(at) < need:
            return np.zeros(0, np.int64)
        length = self.start[at + 1] - self.start[at]
        at = at[np.argsort(length, kind="stable")]
        longest = int(self.start[at[-1] + 1] - self.start[at[-1]])
        long = min(need - 1, int(need / (PROBE_COST * math.log2(longest + 1) + 1)))
        short, rest = at[: len(at) - long], at[len(at) - long :]
        members, count = self._merged(short)
        enough = count >= need - long
        members, count = members[enough], count[enough].astype(np.int64)
        fits = (least[0] * np.maximum(self.size[members], len(query))
                <= least[1] * np.minimum(self.size[members], len(query)))
        fits &= ~skip(members)
        members, count = members[fits], count[fits]
        for k in rest:  # binary search in each long list
            if not len(members):
                break
            entries = self.owner[self.start[k] : self.start[k + 1]]
            place = np.minimum(np.searchsorted(entries, members), len(entries) - 1)
            count += entries[place] == members
        union = self.size[members] + len(query) - count
        return members[least[1] * count >= least[0] * union]

    def _merged(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of some lists in order, and in how many they are."""
        parts = [self.owner[self.start[k] : self.start[k + 1]] for k in lists]
        total = sum(map(len, parts))
        if total <= MERGE_HEAP:
            merged = np.fromiter(heapq.merge(*(p.tolist() for p in parts)), np.int64, total)
        else:  # a stable sort of sorted runs merges them
            merged = np.sort(np.concatenate(parts).astype(np.int64), kind="stable")
        return np.unique(merged, return_counts=True)


def linked(
    index_ids: np.ndarray,
    index_sets: list[np.ndarray],
    query_ids: np.ndarray,
    query_sets: list[np.ndarray],
    least: tuple[int, int],
) -> Iterator[tuple[int, int]]:
    """A forest of the links between queries and members, as pairs of identifiers."""
    ids = np.unique(np.concatenate([index_ids, query_ids]))
    label = np.arange(len(ids))
    member = np.searchsorted(ids, index_ids)
    index = Index(index_sets)
    for node, query in zip(np.searchsorted(ids, query_ids), query_sets, strict=True):
        for hit in member[index.search(query, least, lambda m, n=node: label[member[m]] == label[n])]:
            if label[hit] != label[node]:
                label[label == label[hit]] = label[node]
                yield int(ids[node]), int(ids[hit])


def _members(rows: pd.DataFrame, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Classes and their sets, from the texts of members. Of several rows with one
    identifier those with the class's set count, and of repeated rows the first."""
    classes: list[int] = []
    sets: list[np.ndarray] = []
    seen: set[int] = set()
    for number, digest, text in zip(rows["class"], rows["digest"], rows["text"], strict=True):
        keys = np.unique(shingles(word_hashes(text or ""), width))
        if number not in seen and xxhash.xxh3_128_hexdigest(keys.tobytes()) == digest:
            seen.add(number)
            classes.append(number)
            sets.append(keys)
    return np.array(classes, np.int64), sets


def _search_components(least: tuple[int, int], width: int):
    """Links inside whole candidate components, several of which come together."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        pairs = []
        for _, part in rows.groupby("component"):
            ids, sets = _members(part, width)
            pairs += linked(ids, sets, ids, sets, least)
        return pd.DataFrame(pairs, columns=["a", "b"]).astype(np.int64)

    return run


def _search_block(least: tuple[int, int], width: int):
    """Links between a block of queries and a block of members."""

    def run(members: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        pairs = []
        if len(members) and len(queries):
            pairs = list(linked(*_members(members, width), *_members(queries, width), least))
        return pd.DataFrame(pairs, columns=["a", "b"]).astype(np.int64)

    return run


def member_texts(frame: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """Members (doc_id and more) with their texts, from which searches make the sets:
    texts take less room on the way than hashes."""
    carried = [c for c in members.columns if c != "doc_id"]
    hint = F.broadcast if members.count() <= BROADCAST_CLASSES else (lambda x: x)
    texts = frame.select(F.col(key).cast("long").alias("__id"), F.col(text).alias("text"))
    return texts.join(hint(members), F.col("__id").eqNullSafe(F.col("doc_id"))).select(
        "text", *carried
    )


def similar_texts(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: tuple[int, int] = (85, 100),
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """doc_id, n_shingles and component_id for each row; texts link from a similarity of
    ``least[0] / least[1]`` of their shingles of ``width`` words on."""
    spark = frame.sparkSession
    ship(spark)
    rarity = Rarity.of(frame, text, width)
    rows = stored(text_sets(frame, rarity, key, text, least), "shingle-sets")
    classes = (
        rows.filter(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n_shingles"))
        .select(F.monotonically_increasing_id().alias("class"), "digest", "doc_id", "n_shingles")
    )
    classes = stored(classes, "shingle-classes")
    roots = components(_links(frame, rows, classes, key, text, least, width))
    release(spark)
    named = classes.join(roots, F.col("class") == F.col("node"), "left").select(
        "digest", "doc_id", F.coalesce("component", "class").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    per_class = hot_join(named.select("digest", "root"), smallest, "root").drop("root")
    return hot_join(rows.drop("prefix"), per_class, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _candidates(rows: DataFrame, classes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Components of the classes that share shingles they send and are of like size.

    Sets that link differ in size by no more than ``least``, so texts of any sizes that share a
    passage do not become one component.
    """
    return components(_edges(_sent(rows, classes), least, PAIRED_CLASSES))


def _sent(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """shingle, size and class for the shingles that classes send."""
    # One row per class: its sets are equal, so any row's shingles will do.
    chosen = classes.select(
        "class",
        F.col("digest").alias("__digest"),
        F.col("doc_id").alias("__doc"),
        F.col("n_shingles").alias("size"),
    )
    return rows.join(
        chosen,
        (F.col("digest") == F.col("__digest")) & F.col("doc_id").eqNullSafe(F.col("__doc")),
    ).select(F.explode("prefix").alias("shingle"), "size", "class")


def shared_pairs(
    shingle: np.ndarray, size: np.ndarray, label: np.ndarray, pick: np.ndarray, least: tuple[int, int]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one shingle and unlike labels whose sizes allow a link, the first of them one of
    ``pick``. Rows come by shingle and size."""
    for apart in range(1, len(shingle)):
        pick = pick[pick + apart < len(shingle)]
        pick = pick[(shingle[pick] == shingle[pick + apart])]
        # Sizes grow: where one does not fit, no later one does.
        pick = pick[least[0] * size[pick + apart] <= least[1] * size[pick]]
        if not len(pick):
            return
        fits = pick[label[pick] != label[pick + apart]]
        for low in range(0, len(fits), PAIRS):
            yield fits[low : low + PAIRS], fits[low : low + PAIRS] + apart


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int | None]]:
    """Batches put together and cut where the first column, by which they are sorted, changes.

    A group of more than ``GROUPED_ROWS`` rows comes in parts, which begin with the row that the
    one before ended with; its value comes with each of them."""
    held: list[pa.RecordBatch] = []
    long = None
    for part in batches:
        held.append(part)
        if sum(map(len, held)) <= GROUPED_ROWS:
            continue
        whole = pa.concat_batches(held)
        values = whole.column(0).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if cut:
            yield whole.slice(0, cut), long
        held = [whole.slice(cut)]
        if len(held[0]) > GROUPED_ROWS:
            long = int(values[-1])
            yield held[0], long
            held = [whole.slice(len(whole) - 1)]
    if held:
        yield pa.concat_batches(held), long


def _edges(sent: DataFrame, least: tuple[int, int], paired: int) -> DataFrame:
    """Edges between classes that share a shingle and may link.

    A shingle that up to ``paired`` classes send makes pairs of them, and those count that share
    ``spare`` such shingles, or all they must. Classes that send a commoner one, by size, are
    joined to the first of a run in which each size allows a link with the one before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, long in _groups(batches):
            shingle, size, number = (rows.column(k).to_numpy() for k in range(3))
            new = np.append(True, shingle[1:] != shingle[:-1])[: len(shingle)]
            members = np.diff(np.append(np.flatnonzero(new), len(shingle)))
            few = np.repeat(members, members) <= paired
            if long is not None:
                few &= shingle != long
            begins = new | np.append(True, least[0] * size[1:] > least[1] * size[:-1])[: len(shingle)]
            first = np.maximum.accumulate(np.where(begins, np.arange(len(shingle)), 0))
            joined = np.flatnonzero(~few & (first < np.arange(len(shingle))))
            found = [(number[joined], number[first[joined]], np.zeros(len(joined), np.int64))]
            for i, j in shared_pairs(shingle, size, number, np.flatnonzero(few), least):
                # The larger one must share more of its shingles, the smaller one sends fewer.
                need = np.minimum(-(-least[0] * size[j] // least[1]), spare(size[i]))
                found.append((np.minimum(number[i], number[j]), np.maximum(number[i], number[j]), need))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["a", "b", "need"]
            )

    by_shingle = sent.select("shingle", "size", "class").repartition("shingle")
    found = map_batches(by_shingle.sortWithinPartitions("shingle", "size"), run, "a long, b long, need long")
    counted = found.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("need").alias("joined"), F.max("need").alias("need")
    )
    return counted.filter("joined = 0 OR n >= need").select("a", "b")


def signature(keys: np.ndarray) -> bytes:
    """Of how many shingles each range of hashes has, whether odd. There are as many ranges as
    shingles or up to twice as many, 64 to ``SIGNATURE_BITS``."""
    bits = min(max(64, 1 << max(len(keys) - 1, 0).bit_length()), SIGNATURE_BITS)
    odd = np.bincount((keys & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _signatures(texts: DataFrame, width: int) -> DataFrame:
    """class and signature, from the texts of members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            classes, sets = _members(rows.to_pandas(), width)
            signed = pa.array([signature(keys) for keys in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(classes), signed], names=["class", "signature"])

    signed = map_batches(texts.select("class", "digest", "text"), run, "class long, signature binary")
    return signed.dropDuplicates(["class"])


def close_pairs(
    shingle: np.ndarray, size: np.ndarray, label: np.ndarray, signatures: list[bytes], least: tuple[int, int]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one shingle and unlike labels whose sizes and signatures allow a link. Rows come
    by shingle and size. Of signatures of two lengths the longer is folded to the shorter."""
    words = np.array([len(s) // 8 for s in signatures], np.int64)
    for length in np.unique(words).tolist():
        rows = np.flatnonzero((words >= length) & (words <= length * 2 * -(-least[1] // least[0])))
        folded = np.empty((len(rows), length), np.uint64)
        for of in np.unique(words[rows]).tolist():
            which = np.flatnonzero(words[rows] == of)
            held = np.frombuffer(b"".join(signatures[i] for i in rows[which].tolist()), np.uint64)
            folded[which] = np.bitwise_xor.reduce(held.reshape(len(which), -1, length), 1)
        pick = np.flatnonzero(words[rows] == length)
        for a, b in shared_pairs(shingle[rows], size[rows], label[rows], pick, least):
            both = size[rows[a]] + size[rows[b]]
            most = both - 2 * -(-least[0] * both // (least[0] + least[1]))
            step = max(1, PAIR_WORDS // length)
            unlike = [
                np.bitwise_count(folded[a[k : k + step]] ^ folded[b[k : k + step]]).sum(1, dtype=np.int64)
                for k in range(0, len(a), step)
            ]
            near = np.concatenate(unlike) <= most
            yield rows[a[near]], rows[b[near]]


def _near_edges(sent: DataFrame, signed: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Edges that join the classes with a signature which share a shingle and may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for rows, _ in _groups(batches):
            shingle, size, number = (rows.column(k).to_numpy() for k in range(3))
            label = np.fromiter(map(forest.find, number.tolist()), np.int64, len(number))
            edges: list[tuple[int, int]] = []
            for i, j in close_pairs(shingle, size, label, rows.column(3).to_pylist(), least):
                pairs = zip(number[i].tolist(), number[j].tolist(), strict=True)
                edges += [(a, b) for a, b in pairs if forest.union(a, b)]
            if len(forest.parent) > FOREST_NODES:
                forest.parent.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    own = stored(hot_join(sent, signed.select("class"), "class"), "large-shingles")
    counted = hot_join(own, own.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")), "shingle")
    few = hot_join(counted.filter((F.col("n") > 1) & (F.col("n") <= CELL_CLASSES)), signed, "class")
    few = few.select("shingle", "size", "class", "signature").repartition("shingle")
    near = map_batches(few.sortWithinPartitions("shingle", "size"), run, "a long, b long")
    many = counted.filter(F.col("n") > CELL_CLASSES)
    return near.unionByName(_edges(many, least, 0))


def _placed(candidate: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes of candidate components with their component, and its blocks."""
    members = candidate.select(F.col("node").alias("class"), "component").unionByName(
        candidate.select(F.col("component").alias("class"), "component").distinct()
    )
    members = stored(members.join(classes, "class"), "shingle-members")
    totals = members.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)
        ).cast("long").alias("blocks"),
        F.sum("n_shingles").alias("all_shingles"),
    )
    return stored(hot_join(members, totals, "component"), "shingle-components")


def _links(
    frame: DataFrame,
    rows: DataFrame,
    classes: DataFrame,
    key: str,
    text: str,
    least: tuple[int, int],
    width: int,
) -> DataFrame:
    """Pairs of classes that span the components of the links."""
    spark = frame.sparkSession
    placed = _placed(_candidates(rows, classes, least), classes)
    small, large = placed.filter("blocks = 1"), placed.filter("blocks > 1")
    release(spark)
    if any_large := not large.isEmpty():
        signed = stored(_signatures(member_texts(frame, large, key, text), width), "signatures")
        placed = _placed(components(_near_edges(_sent(rows, classes), signed, least)), classes)
        small, large = small.unionByName(placed.filter("blocks = 1")), placed.filter("blocks > 1")
        release(spark)
        any_large = not large.isEmpty()
    shards = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        4 * math.ceil((small.agg(F.sum("n_shingles")).first()[0] or 0) / BLOCK_SHINGLES),
    )
    found = (
        member_texts(frame, small, key, text)
        .withColumn("shard", F.pmod(F.xxhash64("component"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(_search_components(least, width), "a long, b long")
    )
    if not any_large:
        return found
    texts, again = stored_twice(member_texts(frame, large, key, text), "shingle-member-texts")
    return found.unionByName(_large_links(texts, again, least, width))


def _large_links(
    texts: DataFrame, again: DataFrame, least: tuple[int, int], width: int
) -> DataFrame:
    """Links inside components of several blocks: pivots first, then what they left.

    ``again`` is a second reading of the members, for the queries.
    """
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
    keys = ["component", "block", "queries"]
    first = dealt.groupBy("component").agg(
        F.slice(F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64("class", F.lit(1)), "blocks") == 0, F.col("class")))), 1, PIVOTS).alias("pivots"),
    )
    pivots = first.select("component", F.explode("pivots").alias("pivot"))
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    queries = again.join(
        F.broadcast(pivots.select(F.col("pivot").alias("class"))), "class", "left_semi"
    ).select("component", "class", "digest", "text", every_block.alias("block"), F.lit(0).cast("long").alias("queries"))
    members = dealt.select("component", "block", "class", "digest", "text", F.lit(0).cast("long").alias("queries"))
    near = stored(
        members.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(_search_block(least, width), "a long, b long"),
        "pivot-links",
    )
    per_pivot = near.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    best = (
        pivots.join(per_pivot, F.col("pivot") == F.col("a"))
        .groupBy("component")
        .agg(F.max(F.struct("n", "pivot")).alias("best"))
        .select("component", F.col("best.pivot").alias("pivot"))
    )
    settled = near.join(F.broadcast(best), F.col("a") == F.col("pivot")).select(F.col("b").alias("class"))
    left = stored(again.join(settled, "class", "left_anti"), "unsettled")
    blocks = left.groupBy("component").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES),
            F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES),
        ).cast("long").alias("query_blocks")
    )
    # Few rows: each stands for a component of a block and more.
    blocks = stored(blocks, "query-blocks")
    numbered = left.join(F.broadcast(blocks), "component").withColumn(
        "queries", F.pmod(F.xxhash64("class", F.lit(2)), F.col("query_blocks"))
    )
    found = near
    for number in range(blocks.agg(F.max("query_blocks")).first()[0] or 0):
        # Copies of texts on the way: all members once, one block of queries for each of theirs.
        release(texts.sparkSession)
        queries = numbered.filter(F.col("queries") == number).select(
            "component", "class", "digest", "text", "queries", every_block.alias("block")
        )
        members = dealt.join(F.broadcast(blocks.filter(F.col("query_blocks") > number)), "component").select(
            "component", "block", "class", "digest", "text", F.lit(number).cast("long").alias("queries")
        )
        rest = members.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
            _search_block(least, width), "a long, b long"
        )
        found = found.unionByName(stored(rest, "block-links"))
    return found
