"""Cases that earlier versions got wrong."""

from __future__ import annotations

import itertools
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lavra.llm import language, lm, packing, shingle_join, vectors
from lavra.llm.common import map_batches

WORDS = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_special_tokens_are_looked_for_before_letters_are_lowered():
    ours = packing.ChunkTokenizer(open(WORDS, "rb").read())
    whole = Tokenizer.from_file(WORDS)
    names = [t.content for t in whole.get_added_tokens_decoder().values()]
    assert len(names) == 2
    for name in names:
        for form in (name, name.upper(), name.title(), name.swapcase()):
            for text in (form, f"A{form}b. ", f"x {form}, y", f"ç{form}İ", form + form):
                ids = np.frombuffer(ours.encode(text), "<u4").tolist()
                assert ids == whole.encode(text, add_special_tokens=False).ids, text


def test_words_end_where_the_script_changes():
    text = "我们喜欢python和数据 café привет́мир สวัสดี हिन्दी"
    f = language.features([text, "", "́ab", "x"])
    words = [text[a:b] for a, b in zip(f.start[: f.first_word[1]], f.end, strict=False)]
    assert words == ["我们喜欢", "python", "和数据", "café", "привет́мир", "สวัสดี", "हिन्दी"]
    names = [language.SCRIPT_NAMES[k] for k in f.script[: f.first_word[1]]]
    assert names == ["han", "latin", "han", "latin", "cyrillic", "thai", "devanagari"]
    assert np.diff(f.first_word).tolist() == [7, 0, 1, 1]
    assert (f.start[7], f.end[7], f.start[8], f.end[8]) == (1, 3, 0, 1)


@pytest.fixture(scope="module")
def model(spark):
    rows = [("the cat sat on the mat " * 5, "en"), ("le chat est sur la table " * 5, "fr"), ("der hund und die katze " * 5, "de")]
    return language.train_language_model(spark.createDataFrame(rows, "text string, lang string"))


def labels(texts, model):
    return list(language._label(texts, model))


def test_letters_of_unknown_scripts_count_for_no_language(model):
    (alone, mixed, none) = labels(["我们喜欢和数据", "我们喜欢和 the cat sat", "12 34"], model)
    assert alone[1] == 0.0 and alone[3] == 0.0 and alone[0] in model.languages
    assert mixed[0] == "en" and mixed[1] == pytest.approx(9 / 14)
    assert none[:3] == ("und", 0.0, [])


def test_mixtures_of_languages_stay_in_the_pipeline(spark, model):
    mixture = "the cat sat on the mat " * 8 + "le chat est sur la table " * 6 + "der hund und die katze " * 5
    (found,) = labels([mixture], model)
    assert found[1] < 0.5 and len(found[2]) == 3
    rows = [(1, mixture), (2, "我们喜欢和数据"), (3, "12"), (4, None), (5, "我们 the cat sat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in language.keep_identified(docs, model).collect()} == {1, 5}


def test_the_path_is_the_best_of_all(model):
    """Viterbi against every assignment of languages to the words."""
    texts = ["the chat und table", "cat est die mat on", "katze", "le cat"]
    f = language.features(texts)
    scores = language.word_scores(f, model)
    for penalty in (0.5, 3.0, 12.0):
        path = language.viterbi(scores, f.first_word, penalty)
        for i in range(len(texts)):
            own = scores[f.first_word[i] : f.first_word[i + 1]].astype(float)
            found = path[f.first_word[i] : f.first_word[i + 1]]

            def value(choice):
                changes = sum(a != b for a, b in zip(choice, choice[1:]))
                return sum(own[k, c] for k, c in enumerate(choice)) - penalty * changes

            best = max(map(value, itertools.product(range(own.shape[1]), repeat=len(own))))
            assert value(list(found)) == pytest.approx(best, abs=1e-3)


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS)


def prose(seed, n=40):
    rng = random.Random(seed)
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 500)}" for _ in range(n))


def test_unlike_texts_of_one_id_are_kept_and_one_of_each_group_stays(spark):
    a, b, c, d = (prose(i) for i in range(4))
    near = a + " end"
    docs = rows_of(spark, [(1, a), (2, near), (2, b), (3, c), (3, d), (None, c), (None, None), (None, None), (4, ""), (4, "")])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), "").collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept if r["text"]) == sorted([(1, a), (2, b), (3, c), (3, d)])
    # Rows without words link with nothing, so all of them stay.
    assert len([r for r in kept if not r["text"]]) == 4


def test_extra_columns_with_the_names_of_helpers(spark):
    docs = rows_of(spark, [(1, prose(1)), (2, prose(1)), (3, prose(2))])
    docs = docs.withColumn("row0", F.lit("x")).withColumn("component_id", F.lit(7)).withColumn("id", F.lit(0))
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["row0"], r["component_id"]) for r in kept.collect()) == [(1, "x", 7), (3, "x", 7)]


def test_no_documents(spark):
    docs = rows_of(spark, [(1, "x")]).limit(0)
    assert corpus_pipeline.drop_near_duplicates(spark, docs, "").columns == docs.columns


def test_texts_of_many_sizes_that_share_a_passage_are_no_candidates(spark):
    """A passage in texts of sizes far apart joins none of them, copies of each still link."""
    passage = prose(99, 60)
    texts, n = [], 0
    for k in range(12):
        own = prose(k, int(20 * 1.4**k))
        texts += [f"{passage} {own}", f"{passage} {own} more"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rarity = shingle_join.Rarity.of(docs, "text", 4)
    sets = shingle_join.text_sets(docs, rarity, "doc_id", "text", (85, 100))
    classes = sets.select(F.col("doc_id").alias("class"), "digest", "doc_id", "n_shingles")
    candidates = shingle_join._candidates(sets, classes, (85, 100))
    sizes = candidates.groupBy("component").count().agg(F.max("count")).first()[0]
    assert sizes + 1 <= 4
    found = shingle_join.similar_texts(docs).collect()
    assert all(r["component_id"] == r["doc_id"] - r["doc_id"] % 2 for r in found if r["doc_id"] > 3)


def test_ranges_count_the_texts_that_hold_a_shingle(spark):
    texts = [prose(i, 30) for i in range(40)] + [prose(0, 30)] * 25 + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    levels = shingle_join.shingle_counts(docs, "text", 4, 16)
    counts = np.zeros(1 << 16, np.int64)
    for text in texts:
        keys = np.unique(shingle_join.shingles(shingle_join.word_hashes(text or ""), 4))
        np.add.at(counts, (keys >> np.uint64(48)).astype(int), 1)
    assert (levels == np.minimum(np.round(4 * np.log2(counts + 1)), 255)).all()
    assert levels.max() > 4 * 4


def test_steps_of_sizes_lose_no_link(spark):
    """Sizes at the border of the ratio, with sets that share all they can."""
    words = [f"w{i}" for i in range(400)]
    texts = {n: " ".join(words[: n + 3]) for n in (17, 20, 34, 40, 85, 100, 170, 200, 289, 340)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in shingle_join.similar_texts(docs).collect()}
    for small, large in ((17, 20), (34, 40), (85, 100), (170, 200), (289, 340)):
        assert found[small] == found[large]


def test_packing_digests_of_special_tokens(spark):
    texts = ["<|ENDOFTEXT|>", "a <|StartOfText|> b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = Tokenizer.from_file(WORDS)
    for row in packing.pack(docs, WORDS).collect():
        ids = [*whole.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 0]
        assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_turned_vectors_have_the_cosine():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 16)) * rng.uniform(0.01, 1e6, (50, 1))
    y = vectors.turned(x, 0.955, rng)
    assert np.sum(x * y, 1) / np.linalg.norm(x, axis=1) / np.linalg.norm(y, axis=1) == pytest.approx(0.955)
    assert (vectors.turned(x[:, :1], 0.955, rng) == x[:, :1]).all()


def test_a_search_that_finds_nothing_is_noticed_where_few_queries_have_a_link(monkeypatch):
    """60 links among 6000 queries: 64 audited queries have none, the planted ones do."""
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(1500, 32))
    queries = rng.normal(size=(6000, 32))
    linked = rng.permutation(6000)[:60]
    queries[linked] = vectors.turned(rows[:60], 0.97, rng)
    real = vectors.Graph.search

    def blind(self, unit, beam):
        """Finds nothing until it scans."""
        ids, sims = real(self, unit, beam)
        return (ids, sims) if beam * 4 >= len(self.unit) else (ids, np.full_like(sims, -1))

    monkeypatch.setattr(vectors.Graph, "search", blind)
    graph = vectors.Graph.build(vectors._unit(rows))
    found = vectors.find_links(graph, rows, queries, 0.95)
    assert sum(len(hits) for hits in found) >= 60
    assert all(k in found[i] for k, i in enumerate(linked))


def test_the_index_of_sums_tells_what_can_be_put_together():
    rng = np.random.default_rng(8)
    for _ in range(30):
        left = rng.integers(0, 3, 60) * (rng.random(60) < 0.15)
        left[0] = 0
        sums, lengths = packing.Sums(left), np.flatnonzero(left).tolist()
        for gap in range(1, 60):
            for bits, n in ((sums.one, 1), (sums.two, 2), (sums.three, 3)):
                found = any(sum(c) == gap for c in itertools.combinations_with_replacement(lengths, n))
                assert bool(bits >> gap & 1) == found
            exact = packing._exact(left.copy(), gap, sums)
            able = [
                c
                for n in (1, 2, 3)
                for c in itertools.combinations_with_replacement(lengths, n)
                if sum(c) == gap and all(c.count(x) <= left[x] for x in c)
            ]
            assert (exact is not None) == bool(able)
            assert exact is None or tuple(sorted(exact)) in able


def test_words_are_encoded_without_threads_of_the_library():
    script = """if True:
        import os, sys
        import pyarrow as pa
        from lavra.llm.token_files import BatchTokenizer
        batch = BatchTokenizer(open(sys.argv[1], "rb").read())
        before = len(os.listdir("/proc/self/task"))
        batch.encode(pa.array([f"word{i} Ω{i}" for i in range(500)], pa.large_string()))
        print(len(os.listdir("/proc/self/task")) - before)
    """
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    env["PYTHONPATH"] = str(Path(packing.__file__).parents[2])
    run = [sys.executable, "-c", script, WORDS]
    assert int(subprocess.run(run, env=env, capture_output=True, check=True).stdout) == 0


def anonymous_mb():
    status = Path("/proc/self/status").read_text()
    return int(status.split("RssAnon:")[1].split()[0]) / 1024


def test_a_task_gives_back_what_arrow_holds_in_reserve(spark):
    def lowered(batches):
        for rows in batches:
            held = [pc.utf8_lower(rows.column(0)) for _ in range(100)]
            yield rows.slice(0, len(held) % 2)

    frame = SimpleNamespace(sparkSession=spark, mapInArrow=lambda function, schema: function)
    task = map_batches(frame, lowered, "text string")
    texts = pa.record_batch({"text": pa.array(["A" * 1000] * 1000)})
    pa.default_memory_pool().release_unused()
    before = anonymous_mb()
    for _ in task(iter([texts] * 3)):
        pass
    assert anonymous_mb() - before < 20


BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_plain_words_are_merged_as_the_library_does(monkeypatch):
    subwords = lm.Subwords(Path(BYTES).read_text())
    rng = random.Random(3)
    letters = "aaabbceeiinorstt0199.,-!?<|>éèàçñžłœ"
    words = ["".join(rng.choices(letters, k=rng.choice([1, 2, 3, 5, 9, 14, 40]))).encode() for _ in range(4000)]
    words += [b"a" * n for n in range(1, 40)] + [b"aab" * n for n in range(1, 20)] + [b"<|endoftext|>", b"2020-01-01"]
    odd = [w.encode() for w in ("it's", "'s", "÷", "x×y", "ªº", "漢字", "😀", "а", "a\xa0b", "\x7f")] + [b"\xc3", b"a\xc3b", b"\xa9", b"\xc4\xc5\x80"]
    together = [w for pair in zip(words, odd * 300, strict=False) for w in pair]
    alone = {w: subwords._encode([" " + w.decode("utf-8", "replace")])[0] for w in words + odd}
    for some in (words, together, odd):
        ids, lengths = subwords.flat(some)
        assert lengths.tolist() == [len(alone[w]) for w in some]
        assert ids.tolist() == [i for w in some for i in alone[w]]
    monkeypatch.setattr(subwords, "_encode", None)  # plain words go without it
    assert len(subwords.flat(words)[1]) == len(words)


def test_prefixes_of_many_words_are_counted_together():
    """Batches of words are small, and equal prefixes of different batches cost a row each."""
    subwords = lm.Subwords(Path(BYTES).read_text())
    words = [f"w{i % 7}word{i}".encode() for i in range(6000)]
    parts = [
        pa.record_batch({"word": pa.array(words[i : i + 500], pa.binary()), "n": pa.array([2] * 500, pa.int64())})
        for i in range(0, len(words), 500)
    ]

    class Frame:  # whose tasks are run here
        sparkSession = None

        def __getattr__(self, name):
            return lambda *a, **k: self

    tasks = []
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(lm, "map_batches", lambda frame, task, schema: (tasks.append(task), Frame())[1])
        patch.setattr(lm, "F", SimpleNamespace(sum=lambda c: Frame()))
        lm.count_prefixes(Frame(), SimpleNamespace(value=Path(BYTES).read_text()))
    found = pa.Table.from_batches(list(tasks[0](iter(parts))))
    whole = lm.prefix_counts(*subwords.flat(words), np.full(len(words), 2), subwords.size)
    assert len(found) == len(whole[0])
    rows = sorted(zip(*(found[c].to_pylist() for c in ("pair", "before", "after", "n")), strict=True))
    assert rows == sorted(zip(*(x.tolist() for x in whole), strict=True))


def test_counts_of_words_are_put_together_before_they_leave_a_task(spark, monkeypatch):
    texts = ["", " lead", "tail ", "\t \n", "a B a", None] + [f"word{i % 50} a É" for i in range(500)]
    tables = [lm.counted(lm.word_lists([t or "" for t in texts[i : i + 7]]).flatten()) for i in range(0, len(texts), 7)]
    counts = lm.added_up(tables)
    expected: dict[bytes, int] = {}
    for word in (w for t in texts for w in lm.split_words(t or "")):
        expected[word] = expected.get(word, 0) + 1
    assert dict(zip(lm.as_bytes(counts["word"].combine_chunks()), counts["n"].to_pylist(), strict=True)) == expected
    assert len(lm.added_up([])) == 0
    rows = lm.count_words(spark.createDataFrame([(t,) for t in texts], "text string"), "text").collect()
    assert {None if r["word"] is None else bytes(r["word"]): r["n"] for r in rows} == expected | {None: len(texts)}


def test_texts_that_share_a_passage_with_the_next_are_no_chain_of_candidates(spark):
    """Neighbours share some words by chance, in ranges too full to tell rare shingles; only the
    copies at the end stay candidates."""
    texts = [f"{prose(1000 + k, 14)} {prose(k, 300)} {prose(1001 + k, 14)}" for k in range(40)]
    texts += [f"{prose(7000, 200)} one", f"{prose(7000, 200)} two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rarity = shingle_join.Rarity(np.zeros(1 << 16, np.uint8), 4)
    sets = shingle_join.text_sets(docs, rarity, "doc_id", "text", (85, 100))
    classes = sets.select(F.col("doc_id").alias("class"), "digest", "doc_id", "n_shingles")
    candidates = shingle_join._candidates(sets, classes, (85, 100)).collect()
    assert [(r["node"], r["component"]) for r in candidates] == [(41, 40)]


@pytest.mark.parametrize("paired,cell", [(0, 2048), (0, 2), (16, 2048)])
def test_large_components_are_narrowed_and_lose_no_link(spark, monkeypatch, paired, cell):
    """Texts of one frame and unlike words: pairs of copies link, the rest does not."""
    monkeypatch.setattr(shingle_join, "PAIRED_CLASSES", paired)
    monkeypatch.setattr(shingle_join, "CELL_CLASSES", cell)
    monkeypatch.setattr(shingle_join, "BLOCK_CLASSES", 8)
    frame = prose(5, 90)
    texts = [f"{frame} {prose(100 + k, 60)}{end}" for k in range(20) for end in ("", " more")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = shingle_join.similar_texts(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i - i % 2 for i in range(40)}


@pytest.mark.parametrize("least", [(85, 100), (80, 100), (30, 100)])
def test_signatures_drop_no_pair_that_links(least):
    rng = np.random.default_rng(3)
    sets = []
    for size in rng.integers(1, 3000, 60).tolist():
        base = rng.integers(0, 2**63, size).astype(np.uint64)
        sets += [np.unique(base), np.unique(base[int(size * rng.random() * 0.4) :]), np.unique(rng.integers(0, 2**63, size).astype(np.uint64))]
    sets = sorted((s for s in sets if len(s)), key=len)
    size = np.array([len(s) for s in sets])
    shingle, label = np.zeros(len(sets), np.int64), np.arange(len(sets))
    signed = [shingle_join.signature(s) for s in sets]
    found = {(i, j) for x, y in shingle_join.close_pairs(shingle, size, label, signed, least) for i, j in zip(x, y, strict=True)}
    both = [(i, j, len(np.intersect1d(sets[i], sets[j]))) for i in range(len(sets)) for j in range(i)]
    linked = {(j, i) for i, j, n in both if least[1] * n >= least[0] * (size[i] + size[j] - n)}
    assert linked and linked <= found
    assert least[0] < 80 or len(found) < len(linked) + 0.02 * len(both)


def test_long_groups_come_in_parts(monkeypatch):
    monkeypatch.setattr(shingle_join, "GROUPED_ROWS", 10)
    values = np.sort(np.repeat([1, 2, 3, 4, 5], [3, 47, 2, 11, 4]))
    batches = [pa.RecordBatch.from_arrays([pa.array(values[k : k + 4]), pa.array(range(k, min(k + 4, 67)))], names=["s", "n"]) for k in range(0, 67, 4)]
    seen, groups = [], {}
    for rows, long in shingle_join._groups(iter(batches)):
        seen += rows.column(1).to_pylist()
        for value in set(rows.column(0).to_pylist()) - {long}:
            assert value not in groups
            groups[value] = rows.column(0).to_pylist().count(value)
    assert sorted(set(seen)) == list(range(67))
    assert {k: groups[k] for k in (1, 3, 5)} == {1: 3, 3: 2, 5: 4}


def test_vectors_are_searched_in_small_pieces(spark, monkeypatch):
    """Graphs in many parts, few queries held: the links are the same, and no row is large."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(600, 16))
    x[300:] = x[:300] + rng.normal(size=(300, 16)) * 0.02
    monkeypatch.setattr(vectors, "PART_BYTES", 4096)
    monkeypatch.setattr(vectors, "HELD_QUERIES", 100)
    blobs = [v.tobytes() for v in x]
    members = pa.RecordBatch.from_pydict(
        {"shard": [5] * 600, "class_id": range(600), "size": [1] * 600, "vector": blobs},
        pa.schema({"shard": pa.int64(), "class_id": pa.int64(), "size": pa.int64(), "vector": pa.binary()}),
    )
    parts = pa.Table.from_batches(vectors._build_shard(iter(members.slice(k, 200) for k in (0, 200, 400))))
    assert parts["part"].to_pylist() == list(range(len(parts))) and len(parts) > 10
    assert max(map(len, parts["payload"].to_pylist())) == 4096
    rows = [(5, 1, k, None, blob) for k, blob in enumerate(parts["payload"].to_pylist())]
    rows += [(5, 1, vectors.QUERY, k, blob) for k, blob in enumerate(blobs)]
    rows += [(6, 1, vectors.QUERY, k, blob) for k, blob in enumerate(blobs[:9])]  # a shard without a graph
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 64], strict=True), kinds, strict=True)], names=list("sbpcv"))
        for k in range(0, len(rows), 64)
    ]
    found = pa.Table.from_batches(vectors.search_blocks(iter(batches), 0.95)).to_pylist()
    assert {r["node"]: (r["links"], r["root"]) for r in found} == {i: (1, i % 300) for i in range(600)}
    frame = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "QUERY_ROWS", 100)
    found = vectors.near_duplicates(frame).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == {i: (1, i % 300) for i in range(600)}
