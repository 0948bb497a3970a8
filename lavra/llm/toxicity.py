"""Toxic passages: maximum-scoring segments over the log-odds of words.

A word's weight is the lower confidence bound of its log-odds between toxic and other
labelled texts, each count with a Dirichlet prior (a share of the word's overall
frequency plus a flat part). Words of at least ``LEAST_WEIGHT`` make the model; every
other word costs ``NEUTRAL``. Maximal scoring segments of a text are found in one scan
with a stack. The scores of segments in harmless text follow an extreme-value law: with
``decay`` the root of E[exp(decay * weight)] = 1 over harmless words, a segment's evidence
is ``decay * score - ln(words of the text)``. A text's evidence is the sum of its
segments' positive evidences, or the largest if none is positive; a logistic curve fitted
to the labelled rows turns it into a score.

All labelled rows are counted. The model holds at most ``MOST_WORDS`` words, those of the
largest weight; the calibration uses counts in ``BINS`` bins of evidence.

NULL texts count as empty, with the evidence of a text of one neutral word. Rows with a
NULL label teach nothing; of several labels of a document the highest counts. Without
rows of both labels every score is the share of toxic labels, or 0 without any.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import map_batches, stored

WORD = re.compile(r"[^\W\d_]+")
PRIOR = 1000.0
FLAT_PRIOR = 0.5
CONFIDENCE = 1.96
LEAST_WEIGHT = 1.5
LEAST_TEXTS = 5
NEUTRAL = 0.3
MOST_WORDS = 50_000
#: Partial counts are sent on when a task holds so many words.
FLUSH_WORDS = 400_000
BINS, LOWEST, HIGHEST = 400, -20.0, 60.0
#: Labels of so many rows, 16 bytes each, are sent to all tasks; more are shuffled.
BROADCAST_LABELS = 1_000_000


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

    def score(self, evidence: float) -> float:
        x = self.intercept + self.slope * evidence
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def segments(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """Maximal scoring segments as (first word, last word, score), in order.

    ``hits`` are the places and weights of the words with a positive weight; all words
    between cost ``NEUTRAL``. Each stack entry holds a segment's places and the running
    totals before and after it.
    """
    stack: list[tuple[int, int, float, float]] = []
    total, at = 0.0, -1
    for place, weight in hits:
        total -= NEUTRAL * (place - at - 1)
        first, before, after = place, total, total + weight
        total, at = after, place
        while stack:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j -= 1
            if j < 0 or stack[j][3] >= after:
                break
            first, before = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((first, place, before, after))
    return [(first, last, after - before) for first, last, before, after in stack]


def passages(text: str, model: ToxicityModel) -> tuple[int, float, list[tuple[int, int, float]]]:
    """Number of words, evidence, and the passages of positive evidence."""
    words = WORD.findall(text.lower())
    n = max(1, len(words))
    found = list(map(model.weights.get, words))
    hits = [(i, w) for i, w in enumerate(found) if w]
    if not hits:
        return len(words), -math.log(n), []
    graded = [(a, b, model.decay * s - math.log(n)) for a, b, s in segments(hits)]
    significant = [g for g in graded if g[2] > 0]
    best = sum(g[2] for g in significant) or max(g[2] for g in graded)
    return len(words), best, significant


def _count_words(frame: DataFrame) -> DataFrame:
    """In how many texts of either label each word stands (toxic 0/1, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            words = list(totals[0].keys() | totals[1].keys())
            columns = [pa.array(words, pa.string())]
            columns += [pa.array([t[w] for w in words], pa.int64()) for t in totals]
            for t in totals:
                t.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "harmless", "toxic"])

        for rows in batches:
            for label, text in zip(rows.column(0), rows.column(1), strict=True):
                totals[label.as_py()].update(set(WORD.findall((text.as_py() or "").lower())))
            if len(totals[0]) + len(totals[1]) > FLUSH_WORDS:
                yield flush()
        yield flush()

    return (
        map_batches(frame, count, "word string, harmless long, toxic long")
        .groupBy("word")
        .agg(F.sum("harmless").alias("harmless"), F.sum("toxic").alias("toxic"))
    )


def labelled_texts(
    frame: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``toxic`` and the text of the rows with a label."""
    single = (
        labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.max(F.col("toxic").cast("int")).alias("__toxic"))
    )
    if single.count() <= BROADCAST_LABELS:
        single = F.broadcast(single)
    texts = frame.select(F.col(key).alias("__doc"), F.col(text).alias("text"))
    return texts.join(single, F.col("__doc") == F.col("__key")).select(
        F.col("__toxic").alias("toxic"), "text"
    )


def train_toxicity_model(rows: DataFrame) -> ToxicityModel:
    """Learn from ``labelled_texts``."""
    counts = stored(_count_words(rows), "toxic-words")
    total = counts.agg(F.sum("harmless").alias("h"), F.sum("toxic").alias("t")).first()
    harmless, toxic = float(total["h"] or 0), float(total["t"] or 0)
    model = ToxicityModel()
    if harmless and toxic:
        share = (F.col("harmless") + F.col("toxic")) / (harmless + toxic)
        prior = PRIOR * share + FLAT_PRIOR
        size = PRIOR + FLAT_PRIOR
        t, h = F.col("toxic") + prior, F.col("harmless") + prior
        odds = F.log(t / (toxic + size - t)) - F.log(h / (harmless + size - h))
        weight = odds - CONFIDENCE * F.sqrt(1 / t + 1 / h)
        kept = (
            counts.select("word", weight.alias("weight"), (h / (harmless + size)).alias("p"), "toxic")
            .filter((F.col("weight") >= LEAST_WEIGHT) & (F.col("toxic") >= LEAST_TEXTS))
            .orderBy(F.desc("weight"), "word")
            .limit(MOST_WORDS)
            .toPandas()
        )
        model.weights = dict(zip(kept["word"], kept["weight"].astype(float), strict=True))
        model.decay = _decay(kept["weight"].to_numpy(float), kept["p"].to_numpy(float))
    _calibrate(model, rows)
    return model


def _decay(weights: np.ndarray, probability: np.ndarray) -> float:
    """The positive root of E[exp(decay * weight)] = 1, by bisection."""
    neutral = max(0.0, 1 - probability.sum())

    def excess(decay: float) -> float:
        return float(
            (probability * np.exp(np.minimum(decay * weights, 700))).sum()
            + neutral * math.exp(-decay * NEUTRAL)
            - 1
        )

    low, high = 1e-3, 5.0
    if not len(weights) or excess(high) < 0:
        return 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def _calibrate(model: ToxicityModel, rows: DataFrame) -> None:
    """Fit the logistic curve to all labelled rows, by their bins of evidence."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    width = (HIGHEST - LOWEST) / BINS

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((BINS, 2), np.int64)
        for part in batches:
            for label, text in zip(part.column(0), part.column(1), strict=True):
                evidence = passages(text.as_py() or "", shared.value)[1]
                at = min(BINS - 1, max(0, int((evidence - LOWEST) / width)))
                table[at, label.as_py()] += 1
        used = np.flatnonzero(table.sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(table[used, 0]), pa.array(table[used, 1])],
            names=["bin", "harmless", "toxic"],
        )

    bins = (
        map_batches(rows, grade, "bin int, harmless long, toxic long")
        .groupBy("bin")
        .agg(F.sum("harmless").alias("h"), F.sum("toxic").alias("t"))
        .collect()
    )
    x = np.array([LOWEST + (row["bin"] + 0.5) * width for row in bins])
    n = np.array([row["h"] + row["t"] for row in bins], float)
    t = np.array([row["t"] for row in bins], float)
    if not n.sum() or not 0 < t.sum() < n.sum():
        model.intercept = -1e3 if not t.sum() else 1e3
        return
    # Newton steps with a weak pull to 0, so that separable labels give a finite curve.
    design = np.stack([np.ones_like(x), x], 1)
    beta = np.array([math.log(t.sum() / (n.sum() - t.sum())), 0.0])
    pull = np.diag([1e-3, 1e-1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (t - n * p) - pull @ beta
        curve = (design * (n * p * (1 - p))[:, None]).T @ design + pull
        step = np.linalg.solve(curve, slope)
        beta = beta + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    model.intercept, model.slope = float(beta[0]), float(max(beta[1], 0.0))


def score_toxicity(
    frame: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """key, score, and the passages: runs of words with their places and evidence."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    kind = frame.schema[key].dataType.simpleString()
    passage = pa.struct(
        [("first_word", pa.int32()), ("last_word", pa.int32()), ("evidence", pa.float64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows in batches:
            scores, found = [], []
            for value in rows.column(1):
                _, evidence, significant = passages(value.as_py() or "", model)
                scores.append(model.score(evidence))
                found.append(
                    [{"first_word": a, "last_word": b, "evidence": e} for a, b, e in significant]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(found, pa.list_(passage)),
                ],
                names=[key, "score", "passages"],
            )

    return map_batches(
        frame.select(key, text),
        run,
        f"`{key}` {kind}, score double, "
        "passages array<struct<first_word:int,last_word:int,evidence:double>>",
    )


def keep_harmless(
    frame: DataFrame, model: ToxicityModel, text: str = "text", below: float = 0.5
) -> DataFrame:
    """Rows whose text scores below a limit."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    at = frame.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for rows in batches:
            scores = (
                model.score(passages(value.as_py() or "", model)[1]) for value in rows.column(at)
            )
            yield rows.filter(pa.array([score < below for score in scores], pa.bool_()))

    return map_batches(frame, keep, frame.schema)
