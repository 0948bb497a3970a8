"""Language of texts and of the spans inside them.

Words are runs of letters of one script. A model holds, per language, hashed counts of letter
trigrams (with word edges) and the scripts of its letters. A word's score for a
language is the log probability of its trigrams; a language whose script share of the
word's script is negligible is no candidate for it. Viterbi search over the words of a
text, with a penalty for every change of language, labels the spans; the language that
covers most letters is the text's.

Training adds up counts over all given rows: each task sums its own rows in an array of
fixed size (buckets x languages) and sends what is not zero. The model's size is bounded
by ``BUCKETS`` x ``MAX_LANGUAGES`` and does not grow with the corpus.

NULL texts and texts without a letter are ``und`` with score 0 and no span. Letters of a script
that no language has count for none: a text of such letters only gets the first language, with
score 0. Rows whose
language is NULL teach nothing. An untrained model (no row) answers ``und`` for
everything. Ties go to the language that sorts first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import map_batches, slices, stored

BUCKETS = 1 << 17
MAX_LANGUAGES = 128
SMOOTHING = 0.5
SWITCH_PENALTY = 12.0
#: A script below this share of a language's training letters is not the language's.
SCRIPT_SHARE = 0.001
UNDETERMINED = "und"

#: First and last code points of scripts. Fixed values (Unicode blocks).
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x323AF),
)
SCRIPT_NAMES = ("none", "other", *dict.fromkeys(name for name, _, _ in SCRIPTS))


#: Script of a mark that belongs to whatever letter it follows.
MARK = 255


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its script (0 if it is no letter) and its lower case. Marks of a
    script (vowel signs, say) are its letters, others belong to the letter before them."""
    script = np.zeros(0x110000, np.uint8)
    lower = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            script[code] = 1
            small = char.lower()
            if len(small) == 1:
                lower[code] = ord(small)
        elif unicodedata.category(char)[0] == "M":
            script[code] = MARK
    for name, first, last in SCRIPTS:
        part = script[first : last + 1]
        part[part > 0] = SCRIPT_NAMES.index(name)
    return script, lower


@dataclass
class Features:
    """Words and trigrams of some texts laid end to end."""

    bucket: np.ndarray  # of each trigram
    trigram_word: np.ndarray  # first trigram of each word
    script: np.ndarray  # of each word
    letters: np.ndarray  # of each word
    start: np.ndarray  # of each word, in its text
    end: np.ndarray
    first_word: np.ndarray  # of each text, with one entry more at the end


def features(texts: list[str]) -> Features:
    script_of, lower_of = tables()
    joined = "\n".join([*texts, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_of[codes]
    if (script == MARK).any():
        script[0] = 0 if script[0] == MARK else script[0]
        held = np.where(script == MARK, 0, np.arange(len(script)))
        script = script[np.maximum.accumulate(held)]
    # A word ends where the script changes; a place between the two letters says so.
    cuts = np.flatnonzero((script[1:] != script[:-1]) & (script[1:] > 0) & (script[:-1] > 0)) + 1
    place_of = np.insert(np.arange(len(codes)), cuts, cuts)
    codes, script = np.insert(codes, cuts, 0), np.insert(script, cuts, 0)
    letter = script > 0
    x = np.where(letter, lower_of[codes], 0).astype(np.uint32)
    before = np.zeros_like(x)
    before[1:] = x[:-1]
    before2 = np.zeros_like(x)
    before2[2:] = np.where(before[2:] > 0, x[:-2], 0)
    place = np.flatnonzero((x > 0) | (before > 0))
    mixed = (
        x[place] * np.uint32(0x9E3779B1)
        ^ (before[place] * np.uint32(0x85EBCA77) + np.uint32(0x165667B1))
        ^ (before2[place] * np.uint32(0xC2B2AE3D) + np.uint32(0x27D4EB2F))
    )
    mixed ^= mixed >> 15
    mixed *= np.uint32(0x2C1B3C6D)
    mixed ^= mixed >> 13
    starts = np.flatnonzero(letter & (before == 0))
    ends = np.flatnonzero((x == 0) & (before > 0))
    offset = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    first_word = np.searchsorted(place_of[starts], offset)
    text_of = np.repeat(np.arange(len(texts)), np.diff(first_word))
    return Features(
        bucket=mixed & np.uint32(BUCKETS - 1),
        trigram_word=np.searchsorted(place, starts),
        script=script[starts],
        letters=ends - starts,
        start=place_of[starts] - offset[text_of],
        end=place_of[ends] - offset[text_of],
        first_word=first_word,
    )


@dataclass
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    allowed: np.ndarray  # scripts x languages, True where the script is the language's


def train_language_model(frame: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts of trigrams and scripts per language, over every row with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        total: dict[int, np.ndarray] = {}
        width = BUCKETS + len(SCRIPT_NAMES)
        for rows in batches:
            texts, langs = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for name in sorted(set(langs)):
                own = [t for t, n in zip(texts, langs, strict=True) if n == name and t]
                k = names.setdefault(name, len(names))
                if k not in total:
                    total[k] = np.zeros(width, np.int64)
                for low, high in slices([len(t) for t in own]):
                    f = features(own[low:high])
                    total[k][:BUCKETS] += np.bincount(f.bucket, minlength=BUCKETS)
                    total[k][BUCKETS:] += np.bincount(
                        f.script, f.letters, minlength=len(SCRIPT_NAMES)
                    ).astype(np.int64)
            if len(names) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for name, k in names.items():
            used = np.flatnonzero(total[k])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(used), pa.string()),
                    pa.array(used, pa.int32()),
                    pa.array(total[k][used], pa.int64()),
                ],
                names=["lang", "cell", "n"],
            )

    rows = frame.select(text, lang).filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    counts = (
        map_batches(rows, count, "lang string, cell int, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
    )
    counts = stored(counts, "language-model")
    languages = [
        row["lang"]
        for row in counts.select("lang").distinct().orderBy("lang").take(MAX_LANGUAGES + 1)
    ]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    cells = counts.toArrow()
    table = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(languages)))
    column = {name: k for k, name in enumerate(languages)}
    table[
        cells["cell"].to_numpy(), [column[name] for name in cells["lang"].to_pylist()]
    ] = cells["n"].to_numpy()
    trigrams, scripts = table[:BUCKETS], table[BUCKETS:]
    smooth = (trigrams + SMOOTHING) / (trigrams.sum(0) + SMOOTHING * BUCKETS)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1)
    return LanguageModel(languages, np.log(smooth).astype(np.float32), allowed & (scripts > 0))


def word_scores(f: Features, model: LanguageModel) -> np.ndarray:
    """Words x languages; -inf where the word's script rules a language out."""
    if not len(f.start):
        return np.zeros((0, len(model.languages)), np.float32)
    scores = np.add.reduceat(model.log_probability[f.bucket], f.trigram_word, axis=0)
    allowed = model.allowed[f.script]
    none = ~allowed.any(1)
    scores[none] = 0
    return np.where(allowed | none[:, None], scores, np.float32(-1e9))


def viterbi(scores: np.ndarray, first_word: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word; texts are searched side by side, word by word."""
    count = np.diff(first_word)
    order = np.argsort(-count, kind="stable")
    start, count = first_word[:-1][order], count[order]
    steps = int(count[0]) if len(count) else 0
    languages = scores.shape[1]
    came = np.zeros((len(scores), languages), np.uint8)
    own = np.arange(languages, dtype=np.uint8)
    value = scores[start[count > 0]].astype(np.float64)
    best_last = np.zeros(len(order), np.int64)
    active = [int(np.searchsorted(-count, -t, "left")) for t in range(steps + 1)]
    for t in range(1, steps + 1):
        live = active[t]  # texts with more than t words
        if live < len(value):
            best_last[live : len(value)] = value[live:].argmax(1)
            value = value[:live]
        if t == steps:
            break
        switch = value.max(1, keepdims=True) - penalty
        stay = value >= switch
        at = start[:live] + t
        came[at] = np.where(stay, own, value.argmax(1).astype(np.uint8)[:, None])
        value = np.where(stay, value, switch) + scores[at]
    path = np.zeros(len(scores), np.int64)
    state = best_last
    for t in range(steps - 1, -1, -1):
        live = active[t]
        at = start[:live] + t
        path[at] = state[:live]
        state[:live] = came[at, state[:live]]
    return path


def label_languages(
    frame: DataFrame, model: LanguageModel, key: list[str], text: str = "text"
) -> DataFrame:
    """``key`` columns, language, score (its share of the letters) and the spans."""
    spark = frame.sparkSession
    shared = spark.sparkContext.broadcast(model)
    names = [*key, "lang_pred", "score", "spans"]
    keys = ", ".join(f"`{k}` {frame.schema[k].dataType.simpleString()}" for k in key)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows in batches:
            texts = [t or "" for t in rows.column(len(key)).to_pylist()]
            # Long texts together: the search takes as many steps as the longest has words.
            order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
            predicted: list[tuple] = [()] * len(texts)
            for low, high in slices([len(texts[i]) for i in order]):
                part = order[low:high]
                for i, found in zip(part, _label([texts[i] for i in part], model), strict=True):
                    predicted[i] = found
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns[: len(key)],
                    pa.array([p[0] for p in predicted], pa.string()),
                    pa.array([p[1] for p in predicted], pa.float64()),
                    pa.array([p[2] for p in predicted], pa.list_(span)),
                ],
                names=names,
            )

    return map_batches(
        frame.select(*key, text),
        label,
        f"{keys}, lang_pred string, score double, "
        "spans array<struct<start:int,end:int,lang:string>>",
    )


def _label(
    texts: list[str], model: LanguageModel
) -> Iterator[tuple[str, float, list[dict], float]]:
    """Language, its share of the letters, spans, and the share of letters of any language."""
    f = features(texts)
    if not model.languages or not len(f.start):
        yield from ((UNDETERMINED, 0.0, [], 0.0) for _ in texts)
        return
    path = viterbi(word_scores(f, model), f.first_word, SWITCH_PENALTY)
    languages = len(model.languages)
    text_of = np.repeat(np.arange(len(texts)), np.diff(f.first_word))
    # Letters of a script that no language has speak for none, whatever span they are in.
    spoken = f.letters * model.allowed.any(1)[f.script]
    letters = np.bincount(
        text_of * languages + path, spoken, minlength=len(texts) * languages
    ).reshape(len(texts), languages)
    total, winner = np.bincount(text_of, f.letters, minlength=len(texts)), letters.argmax(1)
    known = letters.sum(1)
    # A span begins with a text's first word and wherever the language changes.
    begins = np.ones(len(path), bool)
    begins[1:] = (path[1:] != path[:-1]) | (text_of[1:] != text_of[:-1])
    at = np.flatnonzero(begins)
    last = np.append(at[1:], len(path)) - 1
    first_span = np.searchsorted(at, f.first_word)
    start, end, lang = f.start[at].tolist(), f.end[last].tolist(), path[at].tolist()
    for i in range(len(texts)):
        if not total[i]:
            yield UNDETERMINED, 0.0, [], 0.0
            continue
        spans = [
            {"start": start[j], "end": end[j], "lang": model.languages[lang[j]]}
            for j in range(first_span[i], first_span[i + 1])
        ]
        share = float(letters[i, winner[i]] / total[i])
        yield model.languages[winner[i]], share, spans, float(known[i] / total[i])


def keep_identified(
    frame: DataFrame, model: LanguageModel, text: str = "text", least_known: float = 0.5
) -> DataFrame:
    """Rows of whose letters at least ``least_known`` are of some language's script, in
    whatever mixture of languages; a text without letters goes."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    at = frame.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [t or "" for t in rows.column(at).to_pylist()]
            found: list[tuple] = []
            for low, high in slices([len(t) for t in texts]):
                found += _label(texts[low:high], shared.value)
            yield rows.filter(
                pa.array([f[0] != UNDETERMINED and f[3] >= least_known for f in found], pa.bool_())
            )

    return map_batches(frame, keep, frame.schema)
