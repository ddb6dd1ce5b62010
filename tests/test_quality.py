"""Uniqueness, completeness and validity."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from lastro import operators, sources
from lastro.names import AMOUNT, CPF, DUPLICATE_COUNT, ID, NAME, NULL_PERCENT
from lastro.plans.silver import (
    negative_age,
    parsed_values,
    refine,
    refine_observed,
    validity_rules,
)
from lastro.sources.sample import bronze_sample

SF = "/root/testdata/sf0.01"
FEW = settings(max_examples=6, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def by_window(df, *keys):
    size = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn(DUPLICATE_COUNT, size).filter(F.col(DUPLICATE_COUNT) > 1)


# -- uniqueness ---------------------------------------------------------

def test_null_keys_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    found = operators.duplicates(df, "k")
    assert found.columns == ["k", "v", "Qtd_duplicatas"]
    assert found.schema["Qtd_duplicatas"].dataType.typeName() == "long"
    assert bag(found) == Counter({(None, 1, 2): 1, (None, 2, 2): 1})


def test_unique_keys_and_empty_tables_give_no_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "k int, v string")
    assert operators.duplicates(df, "k").count() == 0
    assert operators.duplicates(df.limit(0), "k").count() == 0


def test_whole_copies_are_all_returned(spark):
    df = spark.createDataFrame([(1, "x")] * 5 + [(2, "y")], "k int, v string")
    assert bag(operators.duplicates(df, "k")) == Counter({(1, "x", 5): 5})


def test_key_and_count_names_may_be_awkward(spark):
    df = spark.createDataFrame([(1, 9), (1, 8)], "`a.b` int, Qtd_duplicatas int")
    assert bag(operators.duplicates(df, "a.b")) == Counter({(1, 2): 2})
    named = operators.duplicates(df, "a.b", count_col="n")
    assert bag(named) == Counter({(1, 9, 2): 1, (1, 8, 2): 1})


def test_a_key_is_required(spark):
    with pytest.raises(ValueError):
        operators.duplicates(spark.range(1))


@pytest.mark.parametrize("hot_keys", [1, 3, 50, 100_000])
@pytest.mark.parametrize("room", [0, 200, 10**6])
@pytest.mark.parametrize("keys", [("k",), ("k", "j")])
def test_hot_keys_change_the_plan_but_not_the_rows(spark, hot_keys, room, keys):
    """One key, and NULL, hold a third of the rows each."""
    i = F.col("id")
    df = spark.range(3000, numPartitions=6).select(
        F.when(i % 3 == 0, 7).when(i % 3 == 1, i % 400 + 100).alias("k"),
        F.when(i % 5 > 0, "x").alias("j"), i.alias("v"))
    found = operators.duplicates(df, *keys, hot_keys=hot_keys, broadcast_bytes=room)
    assert bag(found) == bag(by_window(df, *keys))


@pytest.mark.parametrize("skew_join", ["true", "false"])
@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("room", [100_000, 10**8])
def test_no_task_gets_the_rows_of_a_frequent_key(spark, skew_join, wide, room):
    """One key holds a third of the rows; no broadcast but the hinted one."""
    i = F.col("id")
    df = sources.stage(spark.range(300_000, numPartitions=12).select(
        F.when(i % 3 == 0, -1).otherwise(i % 40_000).alias("k"),
        F.when(i % 3 == 0, F.lit("x" * 200)).otherwise(
            F.lpad((i % 40_000).cast("string"), 200, "0")).alias("w"), i.alias("v")),
        "skewed")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.enabled": skew_join,
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    keys = ("k", "w") if wide else ("k",)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = operators.duplicates(df, *keys, hot_keys=100, broadcast_bytes=room)
        by_task = found.groupBy(F.spark_partition_id()).count().collect()
        rows = found.agg(F.count("*"), F.sum("v"), F.sum("Qtd_duplicatas")).first()
        true = by_window(df, *keys).agg(
            F.count("*"), F.sum("v"), F.sum("Qtd_duplicatas")).first()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert rows == true
    assert max(r[1] for r in by_task) < 60_000


def test_a_count_named_like_a_column_replaces_it(spark):
    df = spark.createDataFrame([(1, 5), (1, 6)], "k int, qtd_duplicatas int")
    found = operators.duplicates(df, "k")
    assert found.columns == ["k", "Qtd_duplicatas"]
    assert bag(found) == Counter({(1, 2): 2})


keyed = st.lists(st.tuples(
    st.one_of(st.none(), st.sampled_from(["", "a", "b", "ç", "a "])),
    st.one_of(st.none(), st.sampled_from([0.0, -0.0, float("nan"), 1.5])),
    st.integers(0, 3)), max_size=30)


@FEW
@given(rows=keyed, hot_keys=st.sampled_from([1, 2, 100]))
def test_duplicates_agree_with_a_window(spark, rows, hot_keys):
    df = spark.createDataFrame(rows, "k string, d double, v int")
    for keys in (("k",), ("k", "d")):
        ours = operators.duplicates(df, *keys, hot_keys=hot_keys)
        theirs = by_window(df, *keys)
        text = [F.col(c).cast("string") for c in theirs.columns]
        assert bag(ours.select(text)) == bag(theirs.select(text))


def test_sample_duplicates(spark):
    bronze = bronze_sample(spark, SF)
    assert operators.duplicates(bronze, ID).count() == 60
    by_cpf = operators.duplicates(bronze, CPF)
    assert by_cpf.count() == 14861
    assert by_cpf.filter(F.col(CPF).isNull()).count() == 169


# -- completeness -------------------------------------------------------

def test_null_counts_keep_names_and_ignore_empty_strings(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (None, None)], "a int, `b c` string")
    counts = operators.null_counts(df)
    assert counts.columns == ["a", "b c"]
    assert tuple(counts.first()) == (1, 2)
    assert operators.null_counts(df, ["b c"]).columns == ["b c"]


def test_null_counts_of_nothing_are_unknown(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert tuple(operators.null_counts(empty).first()) == (None, None)
    assert operators.null_percent(empty, "a").first()[0] is None


def test_null_percent_is_a_whole_percent(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") >= 25, F.col("id")).alias("a"),
        F.when(F.col("id") >= 4, F.col("id")).alias("b"))
    single = operators.null_percent(df, "a")
    assert single.columns == [NULL_PERCENT]
    assert single.first()[0] == 3.0
    both = operators.null_percent(df, ["a", "b"], scale=1).first()
    assert both.asDict() == {"a": 2.5, "b": 0.4}
    assert operators.null_percent(df).columns == ["a", "b"]


def test_sample_completeness(spark):
    bronze = bronze_sample(spark, SF)
    counts = operators.null_counts(bronze).first().asDict()
    present = {c: n for c, n in counts.items() if n}
    assert present == {NAME: 100, CPF: 169, AMOUNT: 48}
    assert operators.null_percent(bronze, NAME).first()[0] == 1.0


# -- validity -----------------------------------------------------------

def test_violations_only_show_rows(spark):
    df = spark.createDataFrame([(-1,), (0,), (None,), (30,)], "idade int")
    assert bag(operators.violations(df, negative_age())) == Counter({(-1,): 1})


def test_text_ages_are_compared_as_numbers(spark):
    ages = ["-1", "-1.0", "-5.5", "-99999999999", " -2 ", "x", "9", "-0.0", None, ""]
    df = spark.createDataFrame([(a,) for a in ages], "idade string")
    for rule in (negative_age(), negative_age(df)):
        assert bag(operators.violations(df, rule)) == Counter(
            {(a,): 1 for a in ages[:5]})
    assert operators.cast_rejects(df, {"idade": parsed_values()["idade"]}).first()[0] == 4


def test_cast_rejects_count_lost_values_not_missing_ones(spark):
    df = spark.createDataFrame([("R$ 1",), ("x",), (None,), ("",)], "m string")
    parsed = operators.parse_money(df, "m").columns
    assert parsed == ["m"]
    from lastro.functions import money
    lost = operators.cast_rejects(df, {"m": (F.col("m"), money(F.col("m")))})
    assert lost.first()["m"] == 2


def test_sample_validity(spark):
    bronze = bronze_sample(spark, SF)
    assert operators.violations(bronze, negative_age()).count() == 72
    profile = operators.quality_profile(
        bronze, parsed_values(), validity_rules(bronze)).first().asDict()
    assert profile["total_linhas"] == 15000
    assert profile["cpf_fora_do_padrao"] == 153
    assert profile["idade_negativa"] == 72
    assert profile["rejeitados_valor_transacao"] == 50
    assert profile["rejeitados_saldo_apos_transacao"] == 0
    assert profile["rejeitados_data_transacao"] == 38


def test_metrics_observed_on_the_way_equal_a_pass_of_their_own(spark):
    bronze = bronze_sample(spark, SF)
    report = Observation()
    observed = refine_observed(bronze, report)
    assert observed.schema.simpleString() == refine(bronze).schema.simpleString()
    assert bag(observed) == bag(refine(bronze))
    assert report.get == operators.quality_profile(
        bronze, parsed_values(), validity_rules(bronze)).first().asDict()
