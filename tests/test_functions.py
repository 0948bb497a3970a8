from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lavra import functions as fn
from lavra.functions.text import ACCENTED, CONTROL_REPAIRS, UNACCENTED


def test_clean_text_trims_spaces_only_and_nulls_blanks(column):
    values = ["  a ", "   ", "", None, "\ta", " b ", "A \u0096 B"]
    assert column(lambda c: fn.clean_text(c, CONTROL_REPAIRS), values) == [
        "a",
        None,
        None,
        None,
        "\ta",
        " b",
        "A – B",
    ]


def test_digits_only(column):
    assert column(fn.digits_only, ["12.345/0001-9", "abc", "", None, "007"]) == [
        "1234500019",
        None,
        None,
        None,
        "007",
    ]


def test_first_integer(column):
    assert column(fn.first_integer, ["1º", "x 22 y 3", "none", "", None]) == [
        1,
        22,
        None,
        None,
        None,
    ]


def test_fixed_width_key_never_cuts(column):
    values = ["12.345", "12345678", "123456789", "0", "", "abc", None]
    assert column(fn.fixed_width_key, values) == [
        "00012345",
        "12345678",
        None,
        "00000000",
        None,
        None,
        None,
    ]


def test_usable_key_drops_null_and_reserved(spark):
    frame = spark.createDataFrame([("00000000",), (None,), ("00000001",)], "k string")
    assert [r["k"] for r in frame.filter(fn.is_usable_key(frame["k"])).collect()] == ["00000001"]


def test_strong_name_key(column):
    values = [
        "Itaú Unibanco S.A. (Conglomerado)",
        " crédito & fomento  ",
        "CR�DITO",
        "---",
        "ÑANDU",
        None,
        "A (Conglomerado) B",
    ]
    assert column(fn.strong_name_key, values) == [
        "ITAU UNIBANCO S A",
        "CREDITO FOMENTO",
        "CR DITO",
        "",
        "ANDU",
        None,
        "A CONGLOMERADO B",
    ]


def test_drop_suffix(column):
    values = ["A  (X) \n", "A (X) (X)", "(X) A", "(X)", "A ", None, "A(X)", "A (X)\t b"]
    assert column(lambda c: fn.drop_suffix(c, "(X)"), values) == [
        "A",
        "A (X)",
        "(X) A",
        "",
        "A ",
        None,
        "A",
        "A (X)\t b",
    ]


def test_weak_name_key_keeps_accents(column):
    assert column(fn.weak_name_key, ["  são \t paulo  s.a. ", None]) == ["SÃO PAULO S.A.", None]


def test_priority_rank(column):
    assert column(fn.priority_rank, ["X Prudencial", "X", None]) == [2, 1, 1]


def test_accent_table_is_aligned(column):
    assert len(ACCENTED) == len(UNACCENTED)
    assert column(fn.fold_accents, [ACCENTED]) == [UNACCENTED]


@pytest.mark.parametrize(
    ("text", "label", "normalized", "value"),
    [
        ("16.699,13", "MILHAR_PONTO_DECIMAL_VIRGULA", "16699.13", 16699.13),
        ("-1.000.000,5", "MILHAR_PONTO_DECIMAL_VIRGULA", "-1000000.5", -1000000.5),
        ("54,79", "DECIMAL_VIRGULA", "54.79", 54.79),
        ("12.5", "DECIMAL_PONTO", "12.5", 12.5),
        ("1.234", "DECIMAL_PONTO", "1.234", 1.234),
        ("0", "INTEIRO", "0", 0.0),
        (None, "NULO", None, None),
        ("1.23,4", "OUTRO_FORMATO", "123.4", 123.4),
        ("n/a", "OUTRO_FORMATO", "n/a", None),
    ],
)
def test_number_notations(column, text, label, normalized, value):
    assert column(fn.number_format, [text]) == [label]
    assert column(fn.normalized_decimal, [text]) == [normalized]
    assert column(lambda c: fn.parse_decimal(c, strict=False), [text]) == [value]


def test_strict_decimal_fails_on_text(column):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(fn.parse_decimal, ["n/a"])


def test_outside_domain_catches_null(column):
    assert column(lambda c: fn.outside_domain(c, [2021, 2022]), [2020, 2021, None], "int") == [
        True,
        False,
        True,
    ]


def test_contains_char_and_blank_are_never_null(column):
    assert column(lambda c: fn.contains_char(c, "�"), ["a�", "a", None]) == [True, False, False]
    assert column(fn.is_blank, ["  ", "", None, "x"]) == [True, True, True, False]


def test_count_occurrences_takes_text_literally(column):
    assert column(lambda c: fn.count_occurrences(c, "a.b"), ["a.ba.b axb", ""]) == [2, 0]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="0123456789./-, ABé", max_size=14), min_size=20, max_size=40))
def test_key_functions_agree_with_plain_python(column, values):
    def width_key(text):
        digits = re.sub("[^0-9]", "", text)
        return digits.rjust(8, "0") if 1 <= len(digits) <= 8 else None

    def name_key(text):
        name = re.sub(r"\s*\(CONGLOMERADO\)\s*$", "", text.strip(" ").upper())
        name = name.translate(str.maketrans(ACCENTED, UNACCENTED))
        return re.sub("[^A-Z0-9]+", " ", name).strip(" ")

    assert column(fn.fixed_width_key, values) == [width_key(v) for v in values]
    assert column(fn.strong_name_key, values) == [name_key(v) for v in values]
