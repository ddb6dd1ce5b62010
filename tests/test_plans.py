"""What Spark is going to do: pushdown, pruning, shuffles, join strategies."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lastro import operators, plans, sources
from lastro.names import CPF, ID, NAME
from lastro.plans.silver import negative_age, parsed_values, validity_rules
from lastro.sources.sample import bronze_sample

SF = "/root/testdata/sf0.01"


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def read_columns(text):
    """Column names of each scan, in plan order."""
    return [re.findall(r"([`\w]+):", schema)
            for schema in re.findall(r"ReadSchema: struct<(.*)>", text)]


@pytest.fixture(scope="module")
def bronze(spark):
    return sources.stage(bronze_sample(spark, SF), "bronze")


@pytest.fixture(scope="module")
def silver(spark, bronze):
    return sources.stage(plans.refine(bronze), "silver")


def test_cleaning_is_one_projection_without_a_shuffle(bronze):
    text = plan(plans.refine(bronze), "simple")
    assert text.count("Project") == 1
    assert "Exchange" not in text


def test_age_check_reaches_the_scan(bronze):
    assert "LessThan(idade,0)" in plan(operators.violations(bronze, negative_age()))


def test_profile_is_one_pass(bronze):
    text = plan(operators.quality_profile(
        bronze, parsed_values(), validity_rules(bronze)))
    assert len(read_columns(text)) == 1
    assert "hashpartitioning" not in text


def test_null_percent_reads_one_column_once(bronze):
    text = plan(operators.null_percent(bronze, NAME))
    assert read_columns(text) == [[NAME]]


def test_products_read_only_their_columns(silver):
    assert read_columns(plan(plans.client_financial_view(silver))) == [
        [NAME, "valor_transacao", "data_transacao"]]
    assert read_columns(plan(plans.bank_indicators(silver))) == [
        [NAME, "valor_transacao", "tipo_transacao", "status_transacao"]]
    risk = read_columns(plan(plans.risk_monitor(silver)))
    assert risk[0] == [NAME, "valor_transacao", "status_transacao"]
    assert all(columns == ["valor_transacao"] for columns in risk[1:])


def test_products_aggregate_before_their_only_shuffle(silver):
    text = plan(plans.client_financial_view(silver), "simple")
    assert text.count("hashpartitioning") == 1
    assert text.index("partial_count") > text.index("hashpartitioning")
    assert "SortAggregate" not in text
    assert "hashpartitioning" not in plan(plans.bank_indicators(silver), "simple")
    threshold = plans.mean_threshold(silver)
    summary = plan(plans.client_summary(silver, threshold), "simple")
    main = summary.split("Subquery")[0]
    assert main.count("hashpartitioning") <= 1


def test_the_mean_is_computed_once(silver):
    risk = plans.risk_monitor(silver)
    risk.collect()
    assert "ReusedSubquery" in plan(risk, "simple")
    assert "Join" not in plan(risk, "simple")


def test_few_repeated_keys_need_no_shuffle_of_rows(bronze):
    text = plan(operators.duplicates(bronze, ID), "simple")
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text
    assert "Window" not in text


def test_unique_keys_need_no_second_scan(spark):
    unique = sources.stage(spark.range(1000), "unique")
    found = operators.duplicates(unique, "id")
    assert found.collect() == []
    final = plan(found, "simple").split("Initial Plan")[0]
    assert "EmptyRelation" in final or "LocalTableScan" in final


def test_counting_reads_the_key_only(bronze):
    text = plan(operators.repeated_keys(bronze, CPF))
    assert read_columns(text) == [[CPF]]
    assert "partial_count" in text


def test_hot_keys_are_kept_out_of_the_shuffle(spark, bronze):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    hot = F.when(F.col(ID) % 3 == 0, "hot").otherwise(F.col(CPF))
    skewed = sources.stage(bronze.withColumn(CPF, hot), "skewed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = operators.duplicates(skewed, CPF)
        text = plan(few, "simple")
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        many = operators.duplicates(skewed, CPF, hot_keys=10, broadcast_bytes=1000)
        text = plan(many, "simple")
        assert "BroadcastHashJoin" in text and "SortMergeJoin" in text
        assert "Union" not in text and "__salt" in text
        assert text.count("FileScan") <= 3  # rows, list of hot keys, of others
        assert many.count() == few.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_counts_can_come_from_file_footers(spark, bronze):
    expected = operators.null_counts(bronze).first()
    path = bronze.inputFiles()[0].rsplit("/", 1)[0]
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        counts = operators.null_counts(spark.read.parquet(path))
        assert "PushedAggregation: [COUNT(*), COUNT(id_transacao)" in plan(counts)
        assert counts.first() == expected
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", v1)
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")


def test_no_query_has_a_cross_join_a_udf_or_a_window(spark):
    import __spark_entry__ as driver
    bad = ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "ArrowEvalPython",
           "BatchEvalPython", "MapInPandas", "FlatMapGroups")
    corpus = driver.corpus.queries() if driver.corpus else {}
    for key, query in driver.queries().items():
        if key in corpus:
            continue
        text = plan(query(spark, "/root/testdata/sf0.001"), "simple")
        assert not [b for b in bad if b in text], key
