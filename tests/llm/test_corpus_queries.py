"""The registered queries on the test tables against plain versions, and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from test_corpus_operators import brute_components, brute_links
from tokenizers import Tokenizer

import corpus_pipeline
from lavra.llm import secret_spans
from lavra.llm.queries import QUERIES

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(LARGER).exists(), reason="no test tables")


def table(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def result(spark, prefix, folder=SMALL):
    (name,) = [n for n in QUERIES if n.startswith(prefix)]
    return QUERIES[name](spark, folder).collect()


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] or "" for r in table(SMALL, "documents")}


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_language_of_held_out_texts(spark):
    truth = {r["doc_id"]: r["lang"] for r in table(LARGER, "documents")}
    rows = result(spark, "op1_", LARGER)
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_packing_of_all_texts(spark, texts):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {}
    for i, text in texts.items():
        ids = [*whole.encode(text, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            expected[i, k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    rows = result(spark, "op2_")
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.02 * math.ceil(sum(r["length"] for r in rows) / 2048) + 1


def test_join_of_all_texts(spark, texts):
    rows = result(spark, "op3_")
    expected = brute_components(texts, (85, 100), 4)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected


def test_scores_of_all_texts(spark, texts):
    words = {i: t.encode().lower().split() for i, t in texts.items()}
    training = [i for i in texts if remainder(i, 7) != 2]
    counts = Counter(w for i in training for w in words[i])
    counts[None] = len(training)
    n, distinct = sum(counts.values()), len(counts)
    rows = result(spark, "op4_")
    assert len(rows) == len(texts)
    for r in rows:
        tokens = [*words[r["doc_id"]], None]
        base = sum(math.log10((counts[w] + 1) / (n + distinct + 1)) for w in tokens)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(counts[w] > 0 for w in tokens))
        assert r["train_tokens"] == n and r["held_out"] == (remainder(r["doc_id"], 7) == 2)
        assert r["score"] < 0


def test_archives_of_all_pages(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in table(SMALL, "pages")}
    last = {}
    for i in sorted(pages):
        last[pages[i]] = i
    rows = result(spark, "op5_")
    assert len(rows) == len(pages)
    for r in rows:
        raw = pages[r["page_id"]]
        kind = "response" if last[raw] == r["page_id"] else "revisit"
        assert (r["payload_bytes"], r["record_type"]) == (len(raw), kind)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r["refers_to"] == (None if kind == "response" else last[raw])


def test_pieces_of_all_texts(spark, texts):
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in result(spark, "op6_"):
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_secrets_of_all_texts(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in table(LARGER, "documents")}
    for r in result(spark, "op7_", LARGER):
        spans = secret_spans.scan(texts[r["doc_id"]])
        base = [s for s in spans if s[1] < 3]
        assert r["base_sha256"] == hashlib.sha256(secret_spans.joined(base).encode()).hexdigest()
        assert r["spans"] == secret_spans.joined(spans)
        assert r["n_hex"] == sum(len(m) >= 24 for m in re.findall("[0-9a-f]+", texts[r["doc_id"]]))


def test_fingerprints_of_all_texts(spark, texts):
    down = sorted(texts, reverse=True)
    following = dict(zip(down, down[1:] + down[:1], strict=True))
    rows = {r["doc_id"]: r for r in result(spark, "op8_")}
    assert rows.keys() == texts.keys()
    by_text = {}
    for i, r in rows.items():
        text, cut = texts[i], len(texts[i]) // 3
        edited = text[: len(text) - cut] + texts[following[i]][:cut]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["n_chars"] == len(text)
        assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.05
    assert np.mean([r["near_next"] for r in rows.values()]) < 0.05


def test_links_of_all_vectors(spark):
    values = {r["vec_id"]: r["embedding"] for r in table(SMALL, "embeddings")}
    rows = result(spark, "op9_")
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows} == brute_links(values, 0.95)


def test_toxicity_of_held_out_texts(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(LARGER, "labels")}
    rows = result(spark, "op10_", LARGER)
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.93
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Each stage against what it should keep of its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r["doc_id"]: r.asDict() for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(SMALL, "labels")}
    for name, stage in corpus_pipeline.STAGES:
        frame = stage(spark, docs, SMALL)
        if name == "packing":
            rows = frame.collect()
            assert {r["doc_id"] for r in rows} == set(kept)
            break
        assert frame.columns == docs.columns
        frame.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        now = {r["doc_id"]: r.asDict() for r in docs.collect()}
        gone = set(kept) - set(now)
        if name == "toxicity":
            assert np.mean([labels.get(i, 1) for i in gone] or [1]) > 0.5
            assert np.mean([labels.get(i) == 1 for i in now]) < 0.06
        elif name == "language":
            assert all(not re.search(r"[^\W\d_]", kept[i]["text"] or "") for i in gone)
        elif name == "near_duplicates":
            groups = brute_components({i: r["text"] for i, r in kept.items()}, (80, 100), 5)
            assert set(now) == {i for i, (_, root) in groups.items() if i == root}
        elif name == "secrets":
            assert set(now) == set(kept)
            for i, row in now.items():
                assert row["text"] == secret_spans.redacted(kept[i]["text"] or "")
        if name != "secrets":
            assert all(now[i] == kept[i] for i in now)
        kept = now
