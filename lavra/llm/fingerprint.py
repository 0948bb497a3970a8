"""I-Match fingerprints with randomised lexicons, in DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band: rare enough to tell
texts apart, common enough not to be noise. It is cut into random parts by hashing:
at each of the ``RATES`` a term falls into one of that many parts, of which ``SUBSETS``
are used. A text's distinct lexicon terms, sorted, give one hash per part. At a coarse
rate a part holds many terms of a long text and at a fine rate few, so some parts survive
an edit whatever the length. The likeness of two fingerprints is the share of equal
hashes among the parts that hold a term of either text.

The lexicon is bounded by ``MOST_TERMS`` (the commonest of the band) and is part of the
plan. A text without lexicon terms is told by the hash of all its terms, a text without
terms by the hash of its characters. NULL counts as empty. Equal texts have equal
fingerprints, also in repeated rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HIGHEST_SHARE = 1 / 40
LOWEST_SHARE = 1 / 5000
LEAST_TEXTS = 2
MOST_TERMS = 1 << 14
RATES = (16, 64, 256, 1024)
SUBSETS = 16
EMPTY = "-"


def terms(text: Column) -> Column:
    """Hashes of the distinct terms (runs of letters and digits, lower case), sorted."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    hashed = F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))
    return F.array_sort(F.array_distinct(hashed))


def lexicon(frame: DataFrame, text: str = "text") -> list[int]:
    """Hashes of the band's terms; their number is bounded."""
    n = frame.count()
    rows = (
        frame.select(F.explode(terms(F.col(text))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .filter(F.col("df").between(max(LEAST_TEXTS, n * LOWEST_SHARE), max(LEAST_TEXTS, n * HIGHEST_SHARE)))
        .orderBy(F.desc("df"), "term")
        .limit(MOST_TERMS)
        .collect()
    )
    return [row["term"] for row in rows]


def _with_fingerprint(frame: DataFrame, text: Column, words: list[int], name: str) -> DataFrame:
    """Adds the array of part hashes. Steps are projections, so nothing is worked out twice."""
    known = f"filter(__all, t -> t IN ({', '.join(map(str, words))}))" if words else "array()"
    columns = [F.col(f"`{c}`") for c in frame.columns]
    step = frame.select(*columns, terms(text).alias("__all"), text.alias("__text"))
    step = step.select(*columns, "__all", "__text", F.expr(known).cast("array<bigint>").alias("__in"))
    step = step.select(
        *columns, "__all", "__text", *(_used(rate).alias(f"__in{rate}") for rate in RATES)
    )
    parts = F.concat(*(_part_hashes(rate) for rate in RATES))
    whole = F.array(
        F.concat(
            F.lit("all"),
            F.when(F.size("__all") > 0, _hash(F.col("__all"))).otherwise(
                F.lower(F.lpad(F.hex(F.xxhash64("__text")), 16, "0"))
            ),
        )
    )
    step = step.select(*columns, "__all", "__text", parts.alias("__parts"))
    empty = F.forall("__parts", lambda p: p == EMPTY)
    return step.select(*columns, F.when(empty, whole).otherwise(F.col("__parts")).alias(name))


def _part(term: Column, rate: int) -> Column:
    return F.pmod(F.xxhash64(term, F.lit(rate)), F.lit(rate))


def _used(rate: int) -> Column:
    """The lexicon terms that fall into the parts used at a rate."""
    return F.filter("__in", lambda t: _part(t, rate) < SUBSETS)


def _part_hashes(rate: int) -> Column:
    used = F.col(f"__in{rate}")
    return F.transform(
        F.sequence(F.lit(0), F.lit(SUBSETS - 1)),
        lambda k: _hash(F.filter(used, lambda t: _part(t, rate) == k)),
    )


def _hash(sorted_terms: Column) -> Column:
    digest = F.substring(F.lpad(F.hex(F.xxhash64(sorted_terms)), 16, "0"), 9, 8)
    return F.when(F.size(sorted_terms) == 0, F.lit(EMPTY)).otherwise(F.lower(digest))


def likeness(left: Column, right: Column) -> Column:
    """Share of equal hashes among the parts that either text fills; 0 to 1."""
    filled = F.zip_with(
        left, right, lambda a, b: ((a != EMPTY) | (b != EMPTY)) & a.isNotNull() & b.isNotNull()
    )
    equal = F.zip_with(left, right, lambda a, b: (a == b) & (a != EMPTY))
    n = F.size(F.filter(filled, lambda x: x))
    return F.when(F.size(left) != F.size(right), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.size(F.filter(equal, lambda x: x)).cast("double"), n), F.lit(0.0))
    )


def fingerprints(
    frame: DataFrame, words: list[int], text: str = "text", name: str = "fingerprint"
) -> DataFrame:
    """All columns and the fingerprint of each text as an array of part hashes."""
    return _with_fingerprint(frame, F.coalesce(F.col(text), F.lit("")), words, name)


def with_next(
    frame: DataFrame,
    key: str,
    carried: list[str],
    prepared: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Each row with the ``carried`` columns of the row of the next smaller key.

    ``prepared`` adds columns that are functions of the others, once for each row.

    The smallest key is followed by the largest. Rows are dealt to ranges of keys of about
    equal numbers, and each range also gets a copy of the first row of the next range, so
    one window per range finds every successor. Equal keys are in order of their content.
    """
    spark = frame.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    splits = sorted(
        set(frame.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.1 / ranges))
    )
    placed = frame.withColumn("__range", _range_of(F.col(key), splits))
    tops = placed.groupBy("__range").agg(F.max(key).alias("__top"))
    order = Window.orderBy("__range")
    # One row per range: each range is followed by the one below, the lowest by the highest.
    above = tops.select(
        "__top",
        F.coalesce(
            F.lead("__range").over(order), F.first("__range").over(order)
        ).alias("__goes_to"),
    )
    copies = (
        placed.join(F.broadcast(above), F.col(key).eqNullSafe(F.col("__top")))
        .withColumn("__range", F.col("__goes_to"))
        .select(*placed.columns, F.lit(True).alias("__copy"))
    )
    both = prepared(placed.withColumn("__copy", F.lit(False)).unionByName(copies))
    window = Window.partitionBy("__range").orderBy(
        "__copy", F.desc_nulls_last(key), *(F.xxhash64(F.col(c)) for c in carried if c in frame.columns)
    )
    columns = [c for c in both.columns if c not in ("__range", "__copy")]
    led = both.select(
        *columns, "__copy", *(F.lead(c).over(window).alias(f"next_{c}") for c in carried)
    )
    return led.filter(~F.col("__copy")).drop("__copy")


def _range_of(key: Column, splits: list[float]) -> Column:
    """Number of splits at or below the key, by two looks at short arrays; NULL comes first."""
    if not splits:
        return F.lit(0)
    width = math.isqrt(len(splits)) + 1
    blocks = [splits[i : i + width] for i in range(0, len(splits), width)]
    value = key.cast("double")
    coarse = F.size(F.filter(F.lit([b[0] for b in blocks]), lambda s: s <= value))
    inner = F.element_at(F.lit(_padded(blocks, width)), F.greatest(coarse, F.lit(1)))
    fine = F.size(F.filter(inner, lambda s: s <= value))
    return F.coalesce((F.greatest(coarse, F.lit(1)) - 1) * width + fine, F.lit(0))


def _padded(blocks: list[list[float]], width: int) -> list[list[float]]:
    return [b + [math.inf] * (width - len(b)) for b in blocks]


def edit_texts(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carried: list[str] | None = None,
    prepared: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Each text's length and its edited text: its last third replaced by the first characters
    of the next text. ``prepared`` adds columns to key and text, of which the ``carried``
    ones come from the next row too, as ``next_``."""
    rows = frame.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    carried = carried or []
    rows = with_next(rows, "key", ["text", *carried], prepared)
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)
    )
    return rows.select(
        F.col("key").alias(key),
        n.cast("long").alias("n_chars"),
        edited.alias("edited"),
        *carried,
        *(f"next_{c}" for c in carried),
    )


def compare_edited(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (see ``edit_texts``), and their likenesses."""
    words = lexicon(frame, text)
    rows = edit_texts(frame, key, text, ["fingerprint"], lambda rows: fingerprints(rows, words))
    rows = fingerprints(rows, words, "edited", "edited_fingerprint")
    return rows.select(
        key,
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("fingerprint", ".").alias("fingerprint"),
        F.array_join("edited_fingerprint", ".").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
