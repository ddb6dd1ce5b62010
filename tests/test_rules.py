"""All rules in one pass, and the quality of each delivery."""

import pytest
from pyspark.sql import functions as F

from lastro import operators, plans, sources
from lastro.names import AGE, CPF, NAME, SOURCE_FILE, Layers
from lastro.plans.silver import validity_rules
from lastro.sources.sample import bronze_sample
from tests.test_tables import HEADER, LINE, deliver

SF = "/root/testdata/sf0.001"


def test_counts_equal_the_single_rules(spark):
    bronze = bronze_sample(spark, SF)
    rules = {**validity_rules(bronze), "sem_nome": F.col(NAME).isNull(),
             "jovem": F.col(AGE) < 30, "nunca": F.lit(False), "nulo": F.lit(None).cast("boolean")}
    broken = operators.rules_broken(bronze, rules)
    counted = {r["regra"]: r["linhas"] for r in operators.count_by_rule(broken).collect()}
    single = {name: operators.violations(bronze, p).count() for name, p in rules.items()}
    assert counted == {name: n for name, n in single.items() if n}
    any_rule = F.lit(False)
    for p in rules.values():
        any_rule = any_rule | F.coalesce(p, F.lit(False))
    assert broken.count() == bronze.filter(any_rule).count()
    order = list(rules)
    for row in broken.collect():
        assert row["regras_quebradas"] == sorted(row["regras_quebradas"], key=order.index)
    plan = broken._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_clashing_names_and_nothing(spark):
    table = spark.createDataFrame([("a", 1), (None, None)], "regras_quebradas string, n int")
    found = operators.rules_broken(table, {"x": F.col("regras_quebradas") == "a",
                                           "y": F.col("n") > 0})
    assert [tuple(r) for r in found.collect()] == [(["x", "y"], 1)]
    assert operators.rules_broken(table.limit(0), {"x": F.lit(True)}).count() == 0
    with pytest.raises(ValueError, match="no rules"):
        operators.rules_broken(table, {})


def test_each_load_is_profiled_once(spark, tmp_path):
    layers = Layers("profiled_bronze")
    sources.ensure_schema(spark, layers.schema(layers.bronze_schema))

    def load(name, *lines, header=HEADER, **options):
        deliver(tmp_path / "in", name, *lines, header=header)
        sources.load_deliveries(spark, str(tmp_path / "in"), layers.bronze, layers.ledger,
                                **options)
        return plans.profile_loads(spark, layers)

    assert len(load("a.csv", LINE, LINE.replace("Ana", ""), LINE.replace(",30,", ",-3,"))) == 1
    assert plans.profile_loads(spark, layers) == []
    assert load("bad.csv", LINE, header=HEADER[::-1]) == []
    assert len(load("b.csv", LINE.replace("R$ 10.50", "?"), "x,too,short")) == 1
    assert len(load("a.csv", LINE.replace("00000000191", "1"), load_changed=True)) == 1
    rows = spark.table(layers.quality).orderBy("total_linhas").collect()
    assert [(r[SOURCE_FILE].rsplit("/", 1)[1], r["total_linhas"]) for r in rows] == [
        ("a.csv", 1), ("b.csv", 2), ("a.csv", 3)]
    assert len({r["carga"] for r in rows}) == 3
    changed, second, first = rows
    assert (first[f"nulos_{NAME}"], first["idade_negativa"], first["registros_corrompidos"]
            ) == (1, 1, 0)
    assert (second["rejeitados_valor_transacao"], second["registros_corrompidos"]) == (1, 1)
    assert changed["cpf_fora_do_padrao"] == 1 and changed[f"nulos_{CPF}"] == 0
    whole = operators.quality_profile(spark.table(layers.bronze),
                                      rules=validity_rules(spark.table(layers.bronze))).first()
    for metric in ("total_linhas", f"nulos_{NAME}", "cpf_fora_do_padrao", "idade_negativa"):
        assert sum(r[metric] for r in rows) == whole[metric]


def test_loading_and_refreshing_from_the_command_line(spark, tmp_path, capsys):
    import json

    from lastro.__main__ import arguments, run
    where = ["--bronze", "cmd_b", "--silver", "cmd_s", "--gold", "cmd_g"]
    deliver(tmp_path / "in", "a.csv", LINE, LINE)
    deliver(tmp_path / "in", "bad.csv", LINE, header=HEADER[::-1])
    for found in (["carregado", "quarentena"], []):
        run(spark, arguments(["load", str(tmp_path / "in"), *where]))
        lines = capsys.readouterr().out.splitlines()
        assert [json.loads(x)["situacao"] for x in lines] == found
    run(spark, arguments(["refresh", "--together", "--corrupt-apart", *where]))
    layers = Layers("cmd_b", "cmd_s", "cmd_g")
    assert spark.table(layers.silver).count() == 2 and spark.table(layers.corrupt).count() == 0
    assert spark.table(layers.quality).count() == 1
    with pytest.raises(SystemExit):
        arguments(["load"])
