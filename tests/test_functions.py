"""Literal vectors of the column functions."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from registrum.functions import codes, contact, labels, taxid, text


def values(spark, fn, *inputs):
    """``fn`` over one or several text columns, in input order."""
    rows = [(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)]
    width = len(rows[0]) - 1
    names = [f"c{i}" for i in range(width)]
    schema = "i int, " + ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame(rows, schema)
    out = df.select("i", fn(*[F.col(n) for n in names]).alias("v"))
    return [r.v for r in out.orderBy("i").collect()]


def test_digits(spark):
    assert values(spark, text.digits, "(11) 222-333", "abc", None) == ["11222333", "", None]
    assert values(spark, text.digits_or_null, "S/N", "12A", "", None) == [None, "12", None, None]


def test_blank_to_null(spark):
    got = values(spark, text.blank_to_null, " Empresa ", "  ", " ", "abc", "\t x ", None)
    assert got == ["Empresa", None, None, "abc", "x", None]


def test_digits_of_length(spark):
    eight = lambda c: text.digits_of_length(c, 8)
    got = values(spark, eight, "12345678", "123", "12.345-678", None)
    assert got == ["12345678", None, "12345678", None]


def test_state(spark):
    assert values(spark, text.state, "sp", " RJ ", "XX", "EX", "", None) == [
        "SP", "RJ", None, None, None, None,
    ]


def test_email(spark):
    got = values(spark, text.email, "bad@@mail", " A@B.Co ", "a b@c.d", "x@y", None)
    assert got == [None, "a@b.co", None, None, None]


@pytest.mark.parametrize(
    ("given_text", "expected"),
    [
        ("USER@ExAmple.com", "USER@example.com"),
        ("a@x.com..", "a@x.com"),
        ("a@ x.com", "a@x.com"),
        ("a..b@x.com", None),
        (".a@x.com", None),
        ("a.@x.com", None),
        ("a@x", None),
        ("a@-x.com", None),
        ("a@x-.com", None),
        ("a@x.c", None),
        ("a@b@x.com", None),
        ("é@x.com", None),
        ("a@" + "x" * 64 + ".com", None),
        ("a@" + "x" * 63 + ".com", "a@" + "x" * 63 + ".com"),
        ("a\n@x.com", None),
        (None, None),
    ],
)
def test_email_strict(spark, given_text, expected):
    assert values(spark, text.email_strict, given_text) == [expected]


def test_email_both(spark):
    got = values(spark, text.email_both, "USER@ExAmple.com", "a@x.com.", "a@ x.com", "a..b@x.com")
    assert got == ["user@example.com", "a@x.com", None, None]


def test_activity_code(spark):
    got = values(spark, codes.activity_code, "1234567", "0111301", "0111-3/01", "12", None)
    assert got == [1234567, 111301, 111301, None, None]


def test_code_list(spark):
    got = values(
        spark, codes.code_list, "11;22,abc1234567", "{1234567,7654321,1234567}",
        "{1234567;7654321}", "", "x", None,
    )
    assert got == [["1234567"], ["1234567", "7654321", "1234567"], None, None, None, None]


def test_code_set_of_literal(spark):
    got = values(
        spark, codes.code_set_of_literal, "{0000002,0000001,0000002}", "{1,x}", "{}", "1,2", None
    )
    assert got == [[1, 2], None, None, None, None]


def test_split_list(spark):
    got = values(spark, codes.split_list, "1234567, 9876543", "1;2,3", "", " ; ,", None)
    assert got == [["1234567", "9876543"], ["1", "2", "3"], None, None, None]


def test_array_literal(spark):
    assert values(spark, lambda c: codes.array_literal(codes.split_list(c)), "1;2", None) == [
        "{1,2}", None,
    ]
    assert values(spark, codes.is_array_literal, "{1}", "", "1,2", None) == [
        True, True, False, None,
    ]


def test_dates(spark):
    got = values(spark, text.ymd_date, "20240101", "20241301", " ", "invalid", None, "2024011")
    assert got == [date(2024, 1, 1), None, None, None, None, None]


def test_decimal_comma(spark):
    got = values(
        spark, text.decimal_comma, "1.234,56", "123,45", "0,00", "abc", None, " ", "nan", "None",
        "1000.50", "inf",
    )
    assert got == [
        Decimal("1234.56"), Decimal("123.45"), Decimal("0.00"), None, None, None, None, None,
        Decimal("100050.00"), None,
    ]


def test_phones(spark):
    assert values(spark, contact.area_code, "2", "02", "002", "0002") == [None, "02", "002", None]
    assert values(spark, contact.phone, "1234567", "12345678", "123456789012") == [
        None, "12345678", None,
    ]
    got = values(
        spark, contact.e164, ("11", "999888777"), ("031", "12345678"), ("1", "12345678"),
        ("11", "x2345678"), (None, "12345678"),
    )
    assert got == ["+5511999888777", "+5503112345678", None, None, None]


def test_person_id(spark):
    got = values(spark, taxid.any_tax_id, "123.456.789-09", "000.000.000-00", "12345678900", "1", None)
    assert got == ["12345678909", None, None, None, None]
    got = values(spark, taxid.person_id, "123.456.789-09", "000.000.000-00", "11222333000181")
    assert got == ["12345678909", None, None]


def test_company_id(spark):
    got = values(
        spark, taxid.company_id_valid, "11222333000181", "11222333000180", "1" * 14, "1", "", None
    )
    assert got == [True, False, False, False, False, None]
    got = values(
        spark, taxid.invalid_company_id, ("12345678", "0001", "00"), ("87654321", "0001", "00"),
        ("11222333", "0001", "81"), (None, "0001", "81"),
    )
    assert got == [True, True, False, False]


def test_mask(spark):
    assert values(spark, taxid.mask_person_id, "12345678909", "1") == ["***456789**", None]


def test_name_key(spark):
    got = values(spark, text.name_key, " SÃO Paulo ", "Mogi-Mirim", "á", "ﬀ", None)
    assert got == ["sao paulo", "mogi-mirim", "a", "ﬀ", None]
    exact = values(spark, text.name_key_exact, " SÃO Paulo ", "ﬀ", None)
    assert exact == ["sao paulo", "ff", None]


def test_labels(spark):
    code = lambda c: labels.label(c.cast("int"), labels.STATUS)
    assert values(spark, code, "02", "9", None) == ["ATIVA", None, None]
    assert values(spark, labels.regime_label, "S", "N", " ", None, "X") == [
        "SIM", "NÃO", "OUTROS", "OUTROS", None,
    ]
    ages = [None, "-1", "0", "12", "13", "20", "21", "30", "80", "81"]
    band = lambda c: labels.age_band(c.cast("int"))
    assert values(spark, band, *ages) == [0, 0, 1, 1, 2, 2, 3, 3, 8, 9]


def brute_valid(x: str, weights) -> bool:
    """Check digits by the long way."""
    if len(x) != len(weights[1]) + 1 or not x.isdigit() or len(set(x)) == 1:
        return False
    for w in weights:
        rest = sum(int(d) * k for d, k in zip(x, w)) % 11
        if int(x[len(w)]) != (0 if rest < 2 else 11 - rest):
            return False
    return True


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text("0123456789", min_size=9, max_size=15), min_size=50, max_size=80))
def test_tax_ids_against_brute_force(spark, ids):
    ids = ids + [i[:9] + f"{n:02d}" for i in ids for n in range(0, 100, 7)]
    people = values(spark, taxid.person_id_valid, *ids)
    firms = values(spark, taxid.company_id_valid, *ids)
    assert people == [brute_valid(i, taxid.PERSON_WEIGHTS) for i in ids]
    assert firms == [brute_valid(i, taxid.COMPANY_WEIGHTS) for i in ids]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text("aZ@. -_9é\t", max_size=14), min_size=60, max_size=90))
def test_cleaners_are_idempotent(spark, texts):
    for fn in (text.blank_to_null, text.email, text.email_strict, text.name_key, text.state):
        once = values(spark, fn, *texts)
        assert values(spark, fn, *once) == once
