"""Hard negatives, token files and alignment against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lavra.llm import alignment, hard_negatives, token_files
from lavra.llm.queries import QUERIES
from lavra.session import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SMALL = "/root/testdata/sf0.001"

ALPHABET = [*"aAbB .,'\n\t<|>éÉßİ中́\x1c १ก-_1▁\x85\xad\x00  ", "the ", " word", "ing", "'s", "日本語"]
SPECIAL = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "<|StartOfText|>", "<s>", "</s>", "<0x41>"]


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    parts = ALPHABET + SPECIAL
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def odd_rows(n):
    rows = [(100 + i, text) for i, text in enumerate(odd_texts(n))]
    rows += [(None, None), (None, "two words"), (7, ""), (8, " "), (9, "a "), (5, "twice"), (5, "twice")]
    rows += [(5, "other"), (11, "b " * 9000), (12, "x" * 20000), (13, "\x01" * 300), (14, "🎉" * 200)]
    return rows


# --- hard negatives -----------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (65, 64, 130), (33, 70, 41), (200, 3, 100)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(0)
    m, k, n = shape
    for a_bits, b_bits in ((8, 8), (40, 20), (62, 62)):  # the last one goes beyond 64 bits
        a = rng.integers(-(2**a_bits), 2**a_bits, (m, k))
        b = rng.integers(-(2**b_bits), 2**b_bits, (k, n))
        assert (hard_negatives.strassen(a, b, 8) == a @ b).all()


def test_leaf_that_a_double_would_round():
    a = np.array([[2**30 + 1, 1]], np.int64)
    assert hard_negatives.strassen(a, a.T.copy())[0, 0] == (2**30 + 1) ** 2 + 1


def brute_negatives(rows):
    part = []
    for place, (i, vector, label) in enumerate(rows):
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        part.append((i, label, [math.floor(256 * x) for x in vector], place))
    out = []
    for i, label, vector, place in part:
        if i % 50:
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v)), j, kind)
            for j, kind, v, other in part
            if other != place
        ]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            window = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(i, j, rank, s[1], -p, -s[0]) for rank, s in enumerate(window[:3], 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, place string"


def mined(frame, **options):
    return sorted(map(tuple, hard_negatives.mine(frame, **options).collect()))


@pytest.mark.parametrize("block", [4096, 2])
def test_negatives_of_ties_repeats_and_odd_rows(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4], int(rng.integers(0, 3))) for i in range(260)]
    rows += [(50, rows[3][1], 0), (50, rows[3][1], 0), (51, rows[3][1], 0)]  # repeated ids
    rows += [(1000, [0.5] * 3, 1), (1050, [], 1), (1001, None, 1), (1100, [float("nan")] * 6, 1)]
    rows += [(1150, [None] * 6, 1), (1200, [float("inf")] * 6, 1), (None, [0.5] * 6, 1), (1250, [0.5] * 6, None)]
    rows += [(1300, [0.0] * 6, 2), (-50, [0.25] * 6, 2)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], VECTORS).repartition(5)
    assert mined(frame, block_anchors=block) == brute_negatives(rows)


def test_negatives_of_one_large_group(spark):
    rng = np.random.default_rng(4)
    same = [float(x) for x in rng.normal(size=8)]
    rows = [(i, same, i % 2) for i in range(900)]
    rows += [(900 + i, [float(x) for x in rng.normal(size=8)], i % 3) for i in range(600)]
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows]
    frame = spark.createDataFrame([(*r, "x") for r in rows], VECTORS).repartition(3)
    assert mined(frame, block_anchors=16) == brute_negatives(rows)


def test_no_rows_and_no_anchors(spark):
    assert mined(spark.createDataFrame([], VECTORS)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1, "x")], VECTORS)) == []


def test_scores_beyond_64_bits_are_refused(spark):
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark.createDataFrame([(50, [1e30], 1, "x")], VECTORS))


# --- token files --------------------------------------------------------------------


def test_batches_agree_with_the_library():
    texts = [text for _, text in odd_rows(4000)]
    batch = token_files.batch_tokenizer(open(WORDS, "rb").read())
    plain = Tokenizer.from_file(WORDS)
    ids, ends = batch.encode(pa.array([t or "" for t in texts], pa.large_string()))
    start = 0
    for text, end in zip(texts, ends.tolist(), strict=True):
        assert ids[start:end].tolist() == plain.encode(text or "", add_special_tokens=False).ids
        start = end


def test_ranks_of_every_width():
    ranks = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    for n in range(len(ranks) + 1):
        control, data = token_files.rank_bytes(ranks[:n])
        assert len(control) == -(-n // 4)
        back = token_files.ranks_of(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n)
        assert (back == ranks[:n]).all()


def test_damaged_blocks_are_refused():
    writer = token_files.BlockWriter(3, np.arange(10, dtype=np.uint32), 4)
    blocks = [*writer.add(1, np.array([1, 2, 3, 4, 5, 6], "<u2")), *writer.rest()]
    content = b"".join(block + b"\n" for block in blocks)
    id_of = np.arange(10, dtype="<u4")
    read = list(token_files.blocks_in(memoryview(content), id_of))
    assert [r[3].tolist() for r in read] == [[1, 2, 3, 4], [5, 6]]
    for at in (0, len(blocks[0]) - 1, len(blocks[0])):
        broken = bytearray(content)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(token_files.blocks_in(memoryview(bytes(broken)), id_of))


@pytest.mark.parametrize(
    "options", [{}, {"block_ids": 64, "shard_ids": 3000, "blocks_per_file": 3}]
)
def test_files_round_trip(spark, options):
    rows = odd_rows(300)
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    path = scratch_path(spark, "files")
    token_files.write_token_files(frame.repartition(6), WORDS, path, **options)
    found = sorted(token_files.token_digests(spark, path).collect(), key=lambda r: r["start"])
    plain = Tokenizer.from_file(WORDS)
    expected = defaultdict(list)
    for i, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        expected[i].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got, start = defaultdict(list), 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
        got[row["doc_id"]].append((row["n_tokens"], row["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    order = [row["doc_id"] for row in found]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    # The commonest id has the shortest code.
    ids = [i for r in token_files.read_token_files(spark, path).collect() for i in r["ids"]]
    ranks = [int(i) for r in spark.read.text(f"{path}/ranks", wholetext=True).collect() for i in r[0].split()]
    counts = Counter(ids)
    assert [counts[i] for i in ranks] == sorted((counts[i] for i in ranks), reverse=True)


def test_no_texts_and_other_identifiers(spark):
    assert token_files.round_trip(spark.createDataFrame([], "doc_id long, text string"), WORDS).collect() == []
    with pytest.raises(TypeError):
        token_files.round_trip(spark.createDataFrame([], "doc_id string, text string"), WORDS)


def test_one_identifier_in_most_rows(spark):
    rows = [(5, f"word {i % 7}") for i in range(900)] + [(i, "x") for i in range(5)] + [(9, "y")] * 5
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    path = scratch_path(spark, "files")
    token_files.write_token_files(frame, WORDS, path, shard_ids=300)
    pieces = token_files.read_token_files(spark, path, ids=False)
    # The rows of the one identifier are spread over shards.
    assert pieces.filter("key = 5").select("shard").distinct().count() > 3
    starts = sorted((r["start"], r["n_tokens"], r["doc_id"]) for r in token_files.token_digests(spark, path).collect())
    assert len(starts) == len(rows) and [s[2] for s in starts] == sorted(r[0] for r in rows)


# --- alignment ----------------------------------------------------------------------


def brute_alignment(rows):
    first = Tokenizer.from_file(BYTES)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    token = {i: t for t, i in first.get_vocab().items()}
    byte = alignment.byte_of_character()
    counts, out = Counter(), []
    for i, text in rows:
        if not text:
            out.append((i, 0, 0, 0, [], ""))
            continue
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        a_bytes = [bytes(byte[c] for c in token[x]) for x in a]
        b_bytes = [
            bytes([int(second.id_to_piece(x)[3:5], 16)])
            if second.is_byte(x)
            else second.id_to_piece(x).replace("▁", " ").encode()
            for x in b
        ]
        raw = (" " + text).encode()
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            out.append((i, 0, 0, 0, [], ""))
            continue
        a_ends = np.cumsum([len(x) for x in a_bytes]).tolist()
        b_ends = np.cumsum([len(x) for x in b_bytes]).tolist()
        groups, start = [], (0, 0)
        for end in sorted(set(a_ends) & set(b_ends)):
            stop = (a_ends.index(end, start[0]) + 1, b_ends.index(end, start[1]) + 1)
            groups.append((a[start[0] : stop[0]], b[start[1] : stop[1]]))
            start = stop
        links = [(x, y) for p, q in groups for x in p for y in q]
        counts.update(set(links))
        written = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        out.append((i, len(a), len(b), len(groups), links, hashlib.sha256(written.encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return Counter(
        (i, na, nb, ng, len(ls), sum(counts[p] == best[p[0]] for p in ls), sum(counts[p] for p in ls), s)
        for i, na, nb, ng, ls, s in out
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most_pairs", [2_000_000, 300, 0])
def test_alignment_of_odd_texts(spark, most_pairs, monkeypatch):
    rng = random.Random(2)
    rows = odd_rows(1500) + [(15, "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(2000)))]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, place string")
    found = alignment.align_texts(frame.repartition(5), BYTES, PIECES, most_pairs=most_pairs)
    assert Counter(map(tuple, found.select(*COLUMNS).collect())) == brute_alignment(rows)


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    """Ends that meet only at the end of the text: two tokens against three, again and again."""
    aligner = alignment.aligner(open(BYTES, "rb").read(), open(PIECES, "rb").read())
    a_ids = np.array([1, 2] * 5 + [3])
    b_ids = np.array([4, 5, 6] * 4)
    groups = [np.array([11]), np.array([12]), np.array([0])]
    expected = Counter((x, y) for x in a_ids.tolist() for y in b_ids.tolist())
    for large in (10**9, 1):
        monkeypatch.setattr(alignment, "LARGE", large)
        of, codes, times = aligner._pairs(a_ids, b_ids, np.zeros(11, int), *groups)
        width = len(aligner.b_bytes)
        found = {divmod(int(c), width): int(t) for c, t in zip(codes, times, strict=True)}
        assert found == expected and (of == 0).all()


def test_pointers_lead_to_the_end_of_the_component():
    rng = np.random.default_rng(5)
    for _ in range(50):
        size = int(rng.integers(1, 60))
        a, b = (
            np.append(np.flatnonzero(rng.random(size - 1) < p) + 1, size) for p in rng.random(2)
        )
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        pointer = alignment.last_of_component(a, b)
        for k, end in enumerate([*a.tolist(), *b.tolist()]):
            assert a[pointer[k]] == next(s for s in shared if s >= end)


def test_no_texts_to_align(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_texts(empty, BYTES, PIECES).collect() == []


def test_queries_of_all_texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    found = QUERIES["op13_tokenizer_alignment"](spark, SMALL)
    assert Counter(map(tuple, found.select(*COLUMNS).collect())) == brute_alignment(rows)
    plain, start, expected = Tokenizer.from_file(WORDS), 0, []
    for i, text in sorted(rows):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = QUERIES["op12_ranked_token_files"](spark, SMALL)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == expected
