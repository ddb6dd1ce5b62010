"""The silver table and the three data products."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lastro import plans
from lastro.names import AMOUNT, DATE, KIND, NAME, STATUS, UNKNOWN_NAME
from lastro.plans.gold import CLIENT_COLUMNS, RISK_COLUMNS
from lastro.sources.sample import bronze_sample

SF = "/root/testdata/sf0.01"
SCHEMA = (f"{NAME} string, {AMOUNT} float, {DATE} date, {KIND} string, "
          f"{STATUS} string")
DAY = dt.date(2024, 1, 1)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture(scope="module")
def silver(spark):
    return plans.refine(bronze_sample(spark, SF)).persist()


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_silver_keeps_rows_columns_and_extras(spark):
    bronze = bronze_sample(spark, SF).withColumn("extra", F.lit("kept"))
    silver = plans.refine(bronze)
    assert silver.columns == bronze.columns
    assert silver.count() == 15000
    types = dict(silver.dtypes)
    assert (types[AMOUNT], types["saldo_apos_transacao"], types[DATE]) == (
        "float", "float", "date")
    nulls = silver.select([F.count_if(F.col(c).isNull()).alias(c)
                           for c in silver.columns]).first()
    assert (nulls[AMOUNT], nulls["saldo_apos_transacao"], nulls[DATE]) == (98, 0, 38)
    assert nulls[NAME] == 0 and nulls["cpf"] == 169
    assert silver.filter(F.col("idade") < 0).count() == 72


def test_silver_options(spark):
    bronze = bronze_sample(spark, SF)
    exact = plans.refine(bronze, money_type="decimal(18,2)", strip_whitespace=True)
    assert dict(exact.dtypes)[AMOUNT] == "decimal(18,2)"
    assert exact.agg(F.sum(AMOUNT)).first()[0].to_eng_string() == "4850431292.80"
    assert bag(exact.select("cidade").distinct()) == Counter(
        {("Recife",): 1, ("Olinda",): 1, ("Curitiba",): 1})
    with pytest.raises(Exception, match="cannot read as"):
        plans.refine(bronze, on_error="fail").write.format("noop").mode(
            "overwrite").save()


def test_client_view_includes_cancelled_and_ignores_missing_amounts(spark):
    rows = table(spark, ("a", 10.0, DAY, "PIX", "Cancelada"),
                 ("a", None, DAY + dt.timedelta(1), "TED", "Concluida"),
                 ("a", 20.0, None, "TED", None), ("b", None, None, None, None))
    assert bag(plans.client_financial_view(rows)) == Counter({
        ("a", 3, 30.0, 15.0, DAY + dt.timedelta(1)): 1,
        ("b", 1, None, None, None): 1})
    done = plans.client_financial_view(rows, where=F.col(STATUS) != "Cancelada")
    assert bag(done) == Counter({("a", 1, None, None, DAY + dt.timedelta(1)): 1})


def test_client_view_key_is_a_choice(spark):
    rows = table(spark, ("a", 1.0, DAY, "PIX", "x"), ("b", 2.0, DAY, "PIX", "x"))
    assert bag(plans.client_financial_view(rows, key=KIND)) == Counter(
        {("PIX", 2, 3.0, 1.5, DAY): 1})


def test_bank_indicators(spark):
    rows = table(spark, ("a", 10.0, DAY, "PIX", "Cancelada"),
                 ("a", None, DAY, "PIX", None), (None, 20.0, DAY, None, "Cancelada"))
    assert tuple(plans.bank_indicators(rows).first()) == (2, 30.0, 3, 15.0, 2, 2)
    assert plans.bank_indicators(rows, distinct_clients=True).first()[0] == 1


def test_products_of_no_transactions(spark):
    none = table(spark, ("a", 1.0, DAY, "PIX", "x")).limit(0)
    assert tuple(plans.bank_indicators(none).first()) == (0, None, 0, None, 0, 0)
    assert plans.client_financial_view(none).count() == 0
    assert plans.risk_monitor(none).count() == 0


def test_risk_threshold_is_strict_and_over_the_whole_table(spark):
    rows = table(spark, ("a", 40.0, DAY, "PIX", "Cancelada"),
                 ("b", 0.0, DAY, "PIX", "x"), ("b", 20.0, DAY, "PIX", None),
                 ("c", None, DAY, "PIX", "Cancelada"))
    assert bag(plans.risk_monitor(rows)) == Counter(
        {("a", 1, 0): 1, ("b", 0, 0): 1, ("c", 1, 0): 1})
    assert bag(plans.risk_monitor(rows, multiplier=1.5)) == Counter(
        {("a", 1, 1): 1, ("b", 0, 0): 1, ("c", 1, 0): 1})
    assert bag(plans.risk_monitor(rows, threshold=F.lit(19.0))) == Counter(
        {("a", 1, 1): 1, ("b", 0, 1): 1, ("c", 1, 0): 1})


def test_above_mean_marks_each_row(spark):
    rows = table(spark, ("a", 50.0, DAY, "PIX", "x"), ("b", 1.0, DAY, "PIX", "x"),
                 ("c", None, DAY, "PIX", "x"), ("d", 9.0, DAY, "PIX", "x"))
    assert bag(plans.above_mean(rows, NAME)) == Counter(
        {("a", 40.0, True): 1, ("b", 40.0, False): 1,
         ("c", 40.0, None): 1, ("d", 40.0, False): 1})


def test_sample_products(silver):
    view = plans.client_financial_view(silver)
    assert view.count() == 1501
    assert view.filter(F.col(NAME) == UNKNOWN_NAME).first()["qtd_transacoes"] == 100
    bank = plans.bank_indicators(silver).first()
    assert bank["qtd_clientes"] == bank["qnt_transacoes"] == 15000
    assert bank["volume_movimentado"] == pytest.approx(4850431294.28, abs=0.01)
    assert bank["media_transacoes"] * 2 == pytest.approx(650977.2238, abs=1e-4)
    assert bank["qnt_transcoes_pix"] == 3750
    assert bank["qnt_transacoes_canceladas"] == 5088
    risk = plans.risk_monitor(silver)
    assert risk.count() == 1501
    totals = risk.agg(*[F.sum(c) for c in RISK_COLUMNS]).first()
    assert tuple(totals) == (5088, 1007)


def test_summary_holds_both_per_client_products(silver):
    summary = plans.client_summary(silver, plans.mean_threshold(silver))
    assert bag(summary.select(NAME, *CLIENT_COLUMNS)) == bag(
        plans.client_financial_view(silver))
    assert bag(summary.select(NAME, *RISK_COLUMNS)) == bag(plans.risk_monitor(silver))


def test_products_agree_with_sql_over_the_same_table(silver, spark):
    import oracles
    silver.createOrReplaceTempView("silver")
    for product, sql in ((plans.client_financial_view, oracles.CLIENT_VIEW),
                         (plans.bank_indicators, oracles.BANK_INDICATORS),
                         (plans.risk_monitor, oracles.RISK)):
        ours, theirs = product(silver), spark.sql(sql)
        assert ours.dtypes == theirs.dtypes
        assert bag(ours) == bag(theirs)
