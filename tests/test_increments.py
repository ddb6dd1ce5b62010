"""Gold from states by delivery equals gold from all rows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lastro import plans, sources
from lastro.names import CANCELLED, NAME, TRANSACTION_COLUMNS, Layers
from lastro.plans.increments import EARLIER, band, mean_of
from lastro.sources.sample import bronze_sample
from tests.test_tables import LINE, bag, deliver

SF = "/root/testdata/sf0.001"
MONEY = "decimal(18,2)"


def silver(spark, rows):
    """(name, amount, date, kind, status) rows as silver has them."""
    table = spark.createDataFrame(
        rows, f"{NAME} string, valor_transacao {MONEY}, data_transacao date, "
        "tipo_transacao string, status_transacao string")
    for column in TRANSACTION_COLUMNS:
        if column not in table.columns:
            table = table.withColumn(column, F.lit("x"))
    return table


def made_up(count, seed, high=3):
    import datetime
    chance = random.Random(seed)
    return [(chance.choice(["Ana", "Bia", "Eva", None]),
             chance.choice([None, Decimal(chance.randrange(-5000, 10 ** chance.randrange(2, high + 4)))
                            / 100]),
             chance.choice([None, datetime.date(2024, 1, chance.randrange(1, 28))]),
             chance.choice(["PIX", "TED"]), chance.choice([CANCELLED, "Concluida"]))
            for _ in range(count)]


def states(spark, name, **options):
    return plans.States(spark, Layers(f"{name}_b", f"{name}_s", f"{name}_g"), **options)


def same(own, rows, multiplier=2, **options):
    assert bag(own.bank_indicators()) == bag(plans.bank_indicators(rows, where=options.get("where")))
    assert own.bank_indicators().dtypes == plans.bank_indicators(rows).dtypes
    view = plans.client_financial_view(rows, **options)
    assert own.client_financial_view().dtypes == view.dtypes
    assert bag(own.client_financial_view()) == bag(view)
    assert bag(own.risk_monitor(multiplier)) == bag(
        plans.risk_monitor(rows, multiplier, **options))


def test_deliveries_add_up_to_a_full_rebuild(spark):
    own, rows = states(spark, "adds"), None
    for number in range(4):
        # the mean moves by orders of magnitude
        new = silver(spark, made_up(60, number, high=number))
        rows = new if rows is None else rows.union(new)
        own.fold(new, f"d{number}")
        same(own, rows)
    same(own, rows, multiplier=0)
    own.fold(silver(spark, made_up(60, 3, high=3)), "d3")  # again
    same(own, rows)
    own.compact()
    assert own.known() == {EARLIER}
    same(own, rows)
    more = silver(spark, made_up(10, 9))
    own.fold(more, "d4")
    own.compact()
    same(own, rows.union(more), multiplier=3)


def test_other_keys_and_conditions(spark):
    own = states(spark, "other", key="tipo_transacao", where="status_transacao <> 'Cancelada'")
    rows = [silver(spark, made_up(80, seed)) for seed in (21, 22)]
    for number, part in enumerate(rows):
        own.fold(part, f"d{number}")
    same(own, rows[0].union(rows[1]), key="tipo_transacao",
         where=F.col("status_transacao") != CANCELLED)


def test_floats_are_equal_but_for_the_order_of_sums(spark):
    rows = plans.refine(bronze_sample(spark, SF))
    own = states(spark, "floats")
    own.fold(rows, "d1")
    assert bag(own.risk_monitor()) == bag(plans.risk_monitor(rows))
    mine, theirs = own.bank_indicators().first(), plans.bank_indicators(rows).first()
    assert mine["volume_movimentado"] == pytest.approx(theirs["volume_movimentado"])
    with pytest.raises(ValueError, match="not of type"):
        own.fold(plans.refine(bronze_sample(spark, SF), money_type=MONEY), "d2")


def test_nothing_and_only_nulls(spark):
    own = states(spark, "nothing")
    none = silver(spark, [])
    own.fold(none, "d1")
    same(own, none)
    nulls = silver(spark, [(None, None, None, None, None)] * 3)
    own.fold(nulls, "d2")
    same(own, nulls)


def test_one_client_with_a_third_of_all_rows(spark):
    rows = silver(spark, made_up(50, 5)).union(
        spark.range(3000).selectExpr("'Ana'", f"CAST(id % 7 AS {MONEY})", "NULL", "'PIX'", "'x'",
                                     *["'x'"] * (len(TRANSACTION_COLUMNS) - 5)))
    own = states(spark, "hot_client")
    own.fold(rows, "d1")
    same(own, rows)
    assert own.read("valores").where(f"cliente = 'Ana'").count() < 60


def test_names_of_deliveries(spark):
    own = states(spark, "named")
    for name in ("2024-01", "12e4", "0007"):
        own.fold(silver(spark, made_up(5, 1)), name)
    assert own.known() == {"2024-01", "12e4", "0007"}
    assert {r[0] for r in own.read("clientes").select("entrega").collect()} == own.known()
    for name in ("a/b", "", EARLIER):
        with pytest.raises(ValueError, match="cannot name"):
            own.fold(silver(spark, []), name)


def test_amounts_are_read_in_one_band(spark):
    own = states(spark, "pruned")
    own.fold(silver(spark, made_up(100, 2)), "d1")
    plan = own.risk_monitor()._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(faixa," in plan


def test_bands_rise_with_amounts(spark):
    values = [None, float("-inf"), -5.0, 0.0, 0.99, 1.0, 1.01, 2.0, 1e6, 1e308, float("inf"),
              float("nan")]
    table = spark.createDataFrame([(v,) for v in values], "v double")
    bands = [r[0] for r in table.select(band(F.col("v"))).collect()]
    assert bands == sorted(bands) and bands[0] == -1 and bands[1:6] == [0] * 5


def test_means_are_rounded_as_avg_rounds(spark):
    chance = random.Random(8)
    for kind in (MONEY, "decimal(10,0)", "decimal(20,5)"):
        scale = int(kind.split(",")[1][:-1])
        rows = [(k, Decimal(chance.randrange(-10 ** 9, 10 ** 9)).scaleb(-scale))
                for k in range(60) for _ in range(chance.randrange(1, 40))]
        table = spark.createDataFrame(rows, f"k int, v {kind}")
        total = f"decimal(38,{scale})"
        found = table.groupBy("k").agg(
            F.avg("v").alias("a"),
            mean_of(F.sum("v").cast(total), F.count("v"), table.schema["v"].dataType).alias("b"))
        assert found.where("a <> b").count() == 0 and dict(found.dtypes)["a"] == dict(
            found.dtypes)["b"]


def test_loads_of_the_ledger_are_folded_once(spark, tmp_path):
    own = states(spark, "loads")
    sources.ensure_schema(spark, own.layers.schema(own.layers.bronze_schema))

    def load(*lines, name="a.csv", **options):
        deliver(tmp_path / "in", name, *lines)
        sources.load_deliveries(spark, str(tmp_path / "in"), own.layers.bronze,
                                own.layers.ledger, **options)
        return plans.fold_loads(own, money_type=MONEY)

    assert len(load(LINE, LINE.replace("10.50", "999.99"))) == 1
    assert load(LINE, LINE.replace("10.50", "999.99"), name="copy.csv") == []
    assert len(load(LINE.replace("Ana", "Bia"), name="b.csv")) == 1
    # the same path with other content is a load of its own
    assert len(load(LINE.replace("Ana", "Eva"), load_changed=True)) == 1
    rows = plans.refine(spark.table(own.layers.bronze), money_type=MONEY)
    assert rows.count() == 4
    same(own, rows)
    assert plans.fold_loads(own, keep=2, money_type=MONEY) == []
    assert own.known() == {EARLIER}
    same(own, rows)
    own.save_gold()
    assert bag(spark.table(own.layers.risk_monitor)) == bag(plans.risk_monitor(rows))


def test_a_delivery_reads_no_old_rows(spark, tmp_path):
    own = states(spark, "reads")
    sources.ensure_schema(spark, own.layers.schema(own.layers.bronze_schema))
    for number in range(3):
        deliver(tmp_path / f"d{number}", f"{number}.csv", *[LINE.replace("Ana", f"N{number}")] * 9)
        sources.load_deliveries(spark, str(tmp_path / f"d{number}"), own.layers.bronze,
                                own.layers.ledger)
        seen = []
        fold = plans.States.fold

        def watched(self, rows, delivery):
            seen.append(rows.count())
            assert "GreaterThanOrEqual(_arquivo_origem" in (
                rows._jdf.queryExecution().executedPlan().toString())
            fold(self, rows, delivery)
        plans.States.fold = watched
        try:
            plans.fold_loads(own, money_type=MONEY)
        finally:
            plans.States.fold = fold
        assert seen == [9]
