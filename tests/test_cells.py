"""Cleaning rules, value by value."""

import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lastro import functions as fn
from lastro import operators
from lastro.names import BAD_FORMAT, UNKNOWN_NAME

FEW = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def apply(spark, values, rule, kind="string"):
    rows = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    cleaned = rows.select("i", rule(F.col("v")).alias("v")).collect()
    return [r["v"] for r in sorted(cleaned)]


def test_missing_name_gets_the_sentinel(spark):
    assert apply(spark, [None, "", "Ana"],
                 lambda c: fn.fill(c, UNKNOWN_NAME)) == [UNKNOWN_NAME, "", "Ana"]


def test_cpf_is_judged_by_length_only(spark):
    values = [None, "abcdefghijk", "123.456.789-01", "", "00000000001", "ção45678901"]
    assert apply(spark, values, lambda c: fn.flag_unless_length(c, 11, BAD_FORMAT)) == [
        None, "abcdefghijk", BAD_FORMAT, BAD_FORMAT, "00000000001", "ção45678901"]


def test_numeric_cpf_is_judged_as_text(spark):
    assert apply(spark, [12345678901, 7, None],
                 lambda c: fn.flag_unless_length(c, 11, BAD_FORMAT),
                 "bigint") == ["12345678901", BAD_FORMAT, None]


def test_trim_takes_spaces_and_optionally_all_whitespace(spark):
    values = ["  Recife ", "\tx\t", " \t São Paulo \r\n", None, "a b"]
    assert apply(spark, values, fn.trimmed) == [
        "Recife", "\tx\t", "\t São Paulo \r\n", None, "a b"]
    assert apply(spark, values, lambda c: fn.trimmed(c, whitespace=True)) == [
        "Recife", "x", "São Paulo", None, "a b"]


def test_money(spark):
    values = ["R$ 123.45", "R$7", "-R$ 5", "R$\t 8.5", "R$ 1R$ 2", "R$ 1.234,56",
              "R$ 9", "", None, "12"]
    assert apply(spark, values, fn.money) == [
        pytest.approx(123.45, rel=1e-6), 7.0, -5.0, 8.5, 12.0, None, None, None,
        None, 12.0]


def test_money_types(spark):
    assert apply(spark, ["R$ 123456.78"], fn.money) == [123456.78125]
    assert apply(spark, ["R$ 123456.78"], lambda c: fn.money(c, "double")) == [123456.78]
    assert apply(spark, ["R$ 123456.78"], lambda c: fn.money(c, "decimal(18,2)")) == [
        Decimal("123456.78")]


def test_money_accepts_what_a_float_cast_accepts(spark):
    nan, inf, suffixed = apply(spark, ["NaN", "R$ Infinity", "12.5d"], fn.money)
    assert nan != nan and inf == float("inf") and suffixed == 12.5


def test_dates(spark):
    values = ["2024-01-02", "2024-01-02 10:11:12", "2024", "02/01/2024", "", None]
    assert [str(d) if d else None
            for d in apply(spark, values, lambda c: fn.typed(c, "date"))] == [
        "2024-01-02", "2024-01-02", "2024-01-01", None, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_values_are_null_or_fail(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert apply(spark, ["R$ 1,5"], fn.money) == [None]
        assert apply(spark, ["R$ 2", None],
                     lambda c: fn.money(c, on_error="fail")) == [2.0, None]
        with pytest.raises(Exception, match=r"cannot read as float: R\$ 1,5"):
            apply(spark, ["R$ 1,5"], lambda c: fn.money(c, on_error="fail"))
        with pytest.raises(Exception, match="cannot read as date: 02/01/2024"):
            apply(spark, ["02/01/2024"],
                  lambda c: fn.typed(c, "date", on_error="fail"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_unknown_error_mode_is_refused():
    with pytest.raises(ValueError):
        fn.typed(None, "date", on_error="drop")


def test_rules_on_a_dataframe_replace_one_column_and_keep_the_rest(spark):
    df = spark.createDataFrame([(1, None, " x ", "R$ 2.5", "3", "2024-01-02")],
                               "id int, `a.b` string, c string, m string, n string, d string")
    df = operators.fill_null(df, "a.b", "none")
    df = operators.trim_col(df, "c")
    df = operators.flag_length(df, "c", 2, "bad")
    df = operators.parse_money(df, "m")
    df = operators.cast_cols(df, {"n": "float", "d": "date"})
    assert df.columns == ["id", "a.b", "c", "m", "n", "d"]
    assert [t for _, t in df.dtypes] == [
        "int", "string", "string", "float", "float", "date"]
    row = df.first()
    assert tuple(row)[:5] == (1, "none", "bad", 2.5, 3.0)


amounts = st.lists(st.one_of(
    st.none(),
    st.text("R$ \t-.,019", max_size=12),
    st.decimals(-10**6, 10**6, places=2).map(lambda d: f"R$ {d}")), max_size=40)


@FEW
@given(values=amounts)
def test_prefix_removal_agrees_with_brute_force(spark, values):
    expected = [v if v is None else re.sub(r"R\$[ \t\n\x0b\f\r]*", "", v)
                for v in values]
    assert apply(spark, values, fn.without_currency) == expected


@FEW
@given(values=amounts)
def test_short_way_for_amounts_agrees_with_the_pattern(spark, values):
    for to in ("float", "decimal(18,2)"):
        assert apply(spark, values, lambda c: fn.money(c, to).cast("string")) == apply(
            spark, values,
            lambda c: fn.typed(fn.without_currency(c), to).cast("string"))


@FEW
@given(values=st.lists(st.text(" \tab\n", max_size=8), max_size=40))
def test_trimming_agrees_with_brute_force(spark, values):
    assert apply(spark, values, fn.trimmed) == [v.strip(" ") for v in values]
    assert apply(spark, values, lambda c: fn.trimmed(c, True)) == [
        v.strip(fn.TRIMMED_WHITESPACE) for v in values]
