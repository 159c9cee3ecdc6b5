import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rowharbor.functions.cells import decode_cell, decode_cells


def decoded(spark, tokens):
    rows = spark.createDataFrame(list(enumerate(tokens)), "n int, t string")
    v = decode_cell(F.col("t"))
    got = rows.select("n", v.cast("string"), F.schema_of_variant(v)).collect()
    return [(r[1], r[2]) for r in sorted(got)]


@pytest.mark.parametrize(
    "token, value, kind",
    [
        ("Null", "Null", "STRING"),
        ("5", "5", "STRING"),
        ('"x"', '"x"', "STRING"),
        ("I32(23)", "23", "BIGINT"),
        ("I32(-23)", "-23", "BIGINT"),
        ("I32(+7)", "7", "BIGINT"),
        ("I64(9223372036854775807)", "9223372036854775807", "BIGINT"),
        ("I64(9223372036854775808)", "9.223372036854776E18", "DOUBLE"),
        ("F64(1.5)", "1.5", "DOUBLE"),
        ("F64(.5)", "0.5", "DOUBLE"),
        ("F64(5.)", "5.0", "DOUBLE"),
        ("F64(1e3)", "1000.0", "DOUBLE"),
        ("F64(-2E-2)", "-0.02", "DOUBLE"),
        ("F64(.)", ".", "STRING"),
        ("F64(e5)", "e5", "STRING"),
        ("F64(NaN)", None, None),
        ("F64(-inf)", None, None),
        ("F64(+Infinity)", None, None),
        ("F64(1e999)", None, None),
        ("I32(12 )", "12 ", "STRING"),
        ("I32( 12)", " 12", "STRING"),
        ("I32(12\n)", "12\n", "STRING"),
        ("F64(1d)", "1d", "STRING"),
        ("F64(0x1p3)", "0x1p3", "STRING"),
        ("I32(1_000)", "1_000", "STRING"),
        ("I32(١)", "١", "STRING"),
        ("Bool(true)", "true", "STRING"),
        ('String("foo")', "foo", "STRING"),
        ('String("42")', "42", "STRING"),
        ('String("")', "", "STRING"),
        ('String("a(b)")', "a(b)", "STRING"),
        ('String("a)', "a", "STRING"),
        ('String(""q"")', "q", "STRING"),
        ('String("a\\"b")', 'a\\"b', "STRING"),
        ("A(B(5))", "B(5", "STRING"),
        ("()", "", "STRING"),
        ("", "", "STRING"),
    ],
)
def test_decode(spark, token, value, kind):
    assert decoded(spark, [token]) == [(value, kind)]


def by_hand(token):
    """The rules in plain Python, for generated tokens."""
    head, opened, rest = token.partition("(")
    if not opened:
        return token
    text = rest.rstrip(")")
    bare = text[1:] if text[:1] in ("+", "-") else text
    if bare and all(c in "0123456789" for c in bare) and -(2**63) <= int(text) < 2**63:
        return int(text)
    if bare.lower() in ("inf", "infinity", "nan"):
        return None
    mantissa, e, exponent = bare.lower().partition("e")
    digits = mantissa.replace(".", "", 1)
    power = exponent[1:] if exponent[:1] in ("+", "-") else exponent
    plain = all(c in "0123456789" for c in digits + power)
    if digits and plain and bool(power) == bool(e):
        number = float(text)
        return number if math.isfinite(number) else None
    return text.strip('"')


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.one_of(
            st.text('I("+-.e019)Na f', max_size=9),
            st.builds("X({})".format, st.text("+-.eE0123", max_size=7)),
            st.builds("F64({!r})".format, st.floats()),
            st.builds("I64({})".format, st.integers(-(2**65), 2**65)),
        ),
        min_size=40,
        max_size=80,
    )
)
def test_decode_against_plain_rules(spark, tokens):
    got = decoded(spark, tokens)
    for token, (value, kind) in zip(tokens, got, strict=True):
        want = by_hand(token)
        if want is None:
            assert value is None and kind is None, token
        elif isinstance(want, int):
            assert (int(value), kind) == (want, "BIGINT"), token
        elif isinstance(want, float):
            assert (float(value), kind) == (want, "DOUBLE"), token
        else:
            assert (value, kind) == (want, "STRING"), token


def test_arrays_decode_like_single_cells(spark):
    tokens = ["I32(1)", "Null", 'String("x")', "F64(nan)"]
    got = (
        spark.createDataFrame([(tokens,)], "t array<string>")
        .select(F.to_json(F.struct(decode_cells(F.col("t")).alias("c"))))
        .first()[0]
    )
    assert got == '{"c":[1,"Null","x",null]}'
