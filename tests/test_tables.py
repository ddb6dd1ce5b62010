"""CSV deliveries, the bronze history, table sinks and the whole refresh."""

import json
import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lastro import operators, plans, sources, streaming
from lastro.names import (
    CORRUPT_RECORD,
    INGESTED_AT,
    NAME,
    SOURCE_FILE,
    TRANSACTION_COLUMNS,
    Layers,
)
from lastro.plans.silver import parsed_values, validity_rules
from lastro.sources.sample import bronze_sample

SF = "/root/testdata/sf0.001"
HEADER = ",".join(TRANSACTION_COLUMNS)
LINE = "1,Ana,00000000191,30,  Recife ,R$ 10.50,5.25,2024-01-02,PIX,Concluida"


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def layers(name):
    return Layers(f"{name}_bronze", f"{name}_silver", f"{name}_gold")


def deliver(folder, name, *lines, header=HEADER):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


# -- tables -------------------------------------------------------------

def test_overwriting_twice_leaves_the_same_rows_and_schema(spark):
    where = layers("twice")
    sources.ensure_schema(spark, where.schema(where.silver_schema))
    silver = plans.refine(bronze_sample(spark, SF))
    for _ in range(2):
        sources.write_table(silver, where.silver)
    back = sources.scan(spark, where.silver)
    assert back.dtypes == silver.dtypes
    assert bag(back) == bag(silver)


def test_writing_into_a_missing_schema_fails(spark):
    with pytest.raises(Exception, match="SCHEMA_NOT_FOUND"):
        sources.write_table(spark.range(1), "nowhere.t")


def test_append_and_format(spark):
    sources.ensure_schema(spark, "formats")
    sources.write_table(spark.range(2), "formats.t", fmt="orc")
    sources.write_table(spark.range(3), "formats.t", mode="append", fmt="orc")
    assert sources.scan(spark, "formats.t").count() == 5


def test_layer_names():
    where = Layers(catalog="lake", gold_schema="odd`name")
    assert where.bronze == "`lake`.`camada_bronze`.`br_transacoes_bancarias`"
    assert Layers().silver == "`camada_prata`.`pr_transacoes_bancarias`"
    assert where.client_view == "`lake`.`odd``name`.`v_finan_cli`"


def test_staged_data_goes_to_the_shared_folder(spark):
    staged = sources.stage(spark.range(5), "numbers")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in staged.inputFiles())
    assert staged.count() == 5


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn", "spark.app.id": "x"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.shared_folder(Session())
    Conf.get = lambda self, key, default=None: {
        "spark.master": "yarn", "spark.app.id": "x",
        "spark.checkpoint.dir": "hdfs:///shared/"}.get(key, default)
    assert sources.shared_folder(Session()) == "hdfs:///shared/lastro/x"


# -- deliveries ---------------------------------------------------------

def test_csv_is_text_and_keeps_zeros_and_blanks(spark, tmp_path):
    deliver(tmp_path / "in", "a.csv", LINE, '2,,7,x,"Rio, RJ","R$ 1.234,56",,,,')
    df = sources.read_csv(spark, str(tmp_path / "in"))
    assert {t for _, t in df.dtypes} == {"string"}
    first, second = sorted(df.collect())
    assert first["cpf"] == "00000000191" and first["cidade"] == "  Recife "
    assert second["cidade"] == "Rio, RJ" and second[NAME] is None


def test_reordered_headers_are_refused(spark, tmp_path):
    swapped = HEADER.replace("cpf,idade", "idade,cpf")
    deliver(tmp_path / "in", "a.csv", LINE, header=swapped)
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        sources.read_csv(spark, str(tmp_path / "in")).select("cpf", "idade").collect()


def test_other_delimiters(spark, tmp_path):
    deliver(tmp_path / "in", "a.csv", LINE.replace(",", ";"),
            header=HEADER.replace(",", ";"))
    assert sources.read_csv(spark, [str(tmp_path / "in")], sep=";").first()[NAME] == "Ana"


def test_history_grows_and_each_row_can_be_traced(spark, tmp_path):
    where = layers("history")
    sources.ensure_schema(spark, where.schema(where.bronze_schema))
    deliver(tmp_path / "d1", "a.csv", LINE)
    deliver(tmp_path / "d2", "b.csv", LINE.replace("Ana", "Bia"), "3,too,short",
            LINE + ",too,long")
    sources.append_history(spark, str(tmp_path / "d1"), where.bronze)
    sources.append_history(spark, [str(tmp_path / "d2")], where.bronze)
    history = sources.scan(spark, where.bronze)
    assert history.columns == [*TRANSACTION_COLUMNS, CORRUPT_RECORD, SOURCE_FILE,
                               INGESTED_AT]
    rows = history.orderBy(SOURCE_FILE, NAME).collect()
    assert [r[SOURCE_FILE].rsplit("/", 1)[1] for r in rows] == [
        "a.csv", "b.csv", "b.csv", "b.csv"]
    assert all(r[INGESTED_AT] for r in rows)
    assert Counter(r[CORRUPT_RECORD] for r in rows) == Counter(
        {None: 2, "3,too,short": 1, LINE + ",too,long": 1})
    refined = plans.refine(history)
    assert refined.columns == history.columns


def test_each_arrival_is_loaded_once(spark, tmp_path):
    where = layers("arrivals")
    sources.ensure_schema(spark, where.schema(where.bronze_schema))
    inbox, log = tmp_path / "in", str(tmp_path / "log")

    def load():
        streaming.ingest_arrivals(spark, str(inbox), where.bronze, log, max_files=1)
        return sources.scan(spark, where.bronze).count()

    deliver(inbox, "a.csv", LINE)
    deliver(inbox, "b.csv", LINE, LINE)
    assert load() == 3
    assert load() == 3
    deliver(inbox, "c.csv", "broken")
    assert load() == 4
    history = sources.scan(spark, where.bronze)
    assert history.select(SOURCE_FILE).distinct().count() == 3
    assert history.filter(F.col(CORRUPT_RECORD) == "broken").count() == 1


def test_a_load_repeated_after_a_failure_doubles_nothing(spark, tmp_path):
    where = layers("repeated")
    sources.ensure_schema(spark, where.schema(where.bronze_schema))
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    deliver(inbox, "a.csv", LINE, LINE)
    deliver(inbox, "b.csv", LINE, header=HEADER.replace("cpf,idade", "idade,cpf"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        streaming.ingest_arrivals(spark, str(inbox), where.bronze, log)
    deliver(inbox, "b.csv", LINE)
    for _ in range(2):
        streaming.ingest_arrivals(spark, str(inbox), where.bronze, log)
        assert sources.scan(spark, where.bronze).count() == 3


# -- the whole refresh --------------------------------------------------

def test_refresh_fills_every_layer(spark):
    where = layers("refresh")
    bronze = bronze_sample(spark, SF)
    sources.ensure_schema(spark, where.schema(where.bronze_schema))
    sources.write_table(bronze, where.bronze)
    for _ in range(2):
        report = plans.refresh(spark, where)
        silver = sources.scan(spark, where.silver)
        assert bag(silver) == bag(plans.refine(bronze))
        assert bag(sources.scan(spark, where.client_view)) == bag(
            plans.client_financial_view(silver))
        assert bag(sources.scan(spark, where.bank_indicators)) == bag(
            plans.bank_indicators(silver))
        assert bag(sources.scan(spark, where.risk_monitor)) == bag(
            plans.risk_monitor(silver))
        assert report.get == operators.quality_profile(
            bronze, parsed_values(), validity_rules(bronze)).first().asDict()


def test_refresh_of_an_empty_bronze_table(spark):
    where = layers("empty")
    sources.ensure_schema(spark, where.schema(where.bronze_schema))
    sources.write_table(bronze_sample(spark, SF).limit(0), where.bronze)
    report = plans.refresh(spark, where).get
    assert report["total_linhas"] == 0 and report["nulos_cpf"] is None
    assert tuple(sources.scan(spark, where.bank_indicators).first()) == (
        0, None, 0, None, 0, 0)
    assert sources.scan(spark, where.risk_monitor).count() == 0


def test_gold_keeps_its_column_names(spark):
    where = layers("names")
    silver = plans.refine(bronze_sample(spark, SF))
    plans.save_gold(silver, where)
    assert sources.scan(spark, where.client_view).dtypes == [
        ("nome_cliente", "string"), ("qtd_transacoes", "bigint"),
        ("total_movimentado", "double"), ("ticket_medio", "double"),
        ("ultima_transacao", "date")]
    assert sources.scan(spark, where.bank_indicators).dtypes == [
        ("qtd_clientes", "bigint"), ("volume_movimentado", "double"),
        ("qnt_transacoes", "bigint"), ("media_transacoes", "double"),
        ("qnt_transcoes_pix", "bigint"), ("qnt_transacoes_canceladas", "bigint")]
    assert sources.scan(spark, where.risk_monitor).dtypes == [
        ("nome_cliente", "string"), ("qnt_transacoes_canceladas", "bigint"),
        ("qnt_valores_3x_acima_media", "bigint")]


def test_check_writes_every_row_it_finds(spark, tmp_path, capsys):
    from lastro.__main__ import arguments, run
    lines = [LINE.replace(",30,", f",-{k},").replace("1,Ana", f"{k // 2},Ana")
             for k in range(1, 101)]
    deliver(tmp_path / "in", "a.csv", *lines)
    where = ["--bronze", "chk_b", "--silver", "chk_s", "--gold", "chk_g"]
    run(spark, arguments(["ingest", str(tmp_path / "in"), *where]))
    run(spark, arguments(["check", "--output", str(tmp_path / "out"), *where]))
    found = json.loads(capsys.readouterr().out)
    assert found["duplicatas"] == 98 and found["violacoes"] == 100
    rows = spark.read.parquet(str(tmp_path / "out" / "duplicatas"))
    assert rows.count() == 98 and "Qtd_duplicatas" in rows.columns
    run(spark, arguments(["check", "--output", str(tmp_path / "out"), "--key", "cpf",
                          "--rule", "idade < -90", *where]))
    found = json.loads(capsys.readouterr().out)
    assert found["duplicatas"] == 100 and found["violacoes"] == 10


def test_gold_takes_its_arguments_from_the_command_line(spark, tmp_path):
    from lastro.__main__ import arguments, run
    deliver(tmp_path / "in", "a.csv", LINE,
            LINE.replace("Concluida", "Cancelada").replace("10.50", "1000"),
            LINE.replace("Ana", "Bia"))
    where = ["--bronze", "arg_b", "--silver", "arg_s", "--gold", "arg_g"]
    run(spark, arguments(["ingest", str(tmp_path / "in"), *where]))
    run(spark, arguments(["refresh", "--key", "cpf", "--where",
                          "status_transacao <> 'Cancelada'", "--distinct-clients",
                          "--multiplier", "0.5", *where]))
    named = Layers("arg_b", "arg_s", "arg_g")
    assert bag(sources.scan(spark, named.risk_monitor)) == Counter(
        {("00000000191", 0, 2): 1})
    bank = sources.scan(spark, named.bank_indicators).first()
    assert bank["qtd_clientes"] == 2 and bank["qnt_transacoes"] == 2
    folder = spark.conf.get("spark.checkpoint.dir")
    left = [f for _, d, _ in os.walk(folder) for f in d if f.startswith("client-summary")]
    assert left == []


def test_steps_from_the_command_line(spark, tmp_path, capsys):
    from lastro.__main__ import arguments, run

    def main(spark, argv):
        run(spark, arguments(argv))

    deliver(tmp_path / "in", "a.csv", LINE, LINE.replace("Ana", ""))
    where = ["--bronze", "cli_b", "--silver", "cli_s", "--gold", "cli_g"]
    main(spark, ["ingest", str(tmp_path / "in"), *where])
    capsys.readouterr()
    main(spark, ["check", "--output", str(tmp_path / "found"), *where])
    found = json.loads(capsys.readouterr().out)
    assert (found["duplicatas"], found["violacoes"], found["total_linhas"]) == (2, 0, 2)
    assert found["percentual_nome_cliente"] == 50.0
    main(spark, ["refresh", "--report", "--money", "decimal(18,2)", *where])
    assert '"nulos_nome_cliente": 1' in capsys.readouterr().out
    risk = sources.scan(spark, Layers("cli_b", "cli_s", "cli_g").risk_monitor)
    assert bag(risk) == Counter({("Ana", 0, 0): 1, ("Não identificado", 0, 0): 1})
    main(spark, ["arrivals", str(tmp_path / "in"), "--log", str(tmp_path / "log"),
                 "--bronze", "cli_arrivals"])
    assert sources.scan(spark, Layers("cli_arrivals").bronze).count() == 2
    for wrong in (["ingest"], ["arrivals", "x"], ["check"]):
        with pytest.raises(SystemExit):
            arguments(wrong)


# -- ingestion that loses nothing ----------------------------------------

def arrive(spark, tmp_path, table, log="log", **options):
    streaming.ingest_arrivals(spark, str(tmp_path / "in"), table,
                              str(tmp_path / log), **options)
    return spark.table(table).count()


def test_a_late_file_of_old_time_is_loaded(spark, tmp_path):
    sources.ensure_schema(spark, "late")
    deliver(tmp_path / "in", "new.csv", LINE)
    assert arrive(spark, tmp_path, "late.t") == 1
    deliver(tmp_path / "in", "old.csv", LINE, LINE)
    old = time.time() - 400 * 86400
    os.utime(tmp_path / "in" / "old.csv", (old, old))
    assert arrive(spark, tmp_path, "late.t") == 3
    assert arrive(spark, tmp_path, "late.t") == 3


def test_batch_and_stream_into_one_table_are_refused(spark, tmp_path):
    sources.ensure_schema(spark, "mixed")
    deliver(tmp_path / "in", "a.csv", LINE, LINE, LINE)
    sources.append_history(spark, str(tmp_path / "in"), "mixed.batch")
    with pytest.raises(ValueError, match="not written by ingest_arrivals"):
        arrive(spark, tmp_path, "mixed.batch")
    assert spark.table("mixed.batch").count() == 3
    assert arrive(spark, tmp_path, "mixed.stream") == 3
    with pytest.raises(ValueError, match="written by ingest_arrivals"):
        sources.append_history(spark, str(tmp_path / "in"), "mixed.stream")
    with pytest.raises(ValueError, match="another checkpoint"):
        arrive(spark, tmp_path, "mixed.stream", log="other")
    assert spark.table("mixed.stream").count() == 3


def test_arrivals_use_the_format_of_session_and_table(spark, tmp_path):
    sources.ensure_schema(spark, "fmts")
    deliver(tmp_path / "in", "a.csv", LINE)
    before = spark.conf.get("spark.sql.sources.default")
    spark.conf.set("spark.sql.sources.default", "orc")
    try:
        assert arrive(spark, tmp_path, "fmts.t") == 1
    finally:
        spark.conf.set("spark.sql.sources.default", before)
    deliver(tmp_path / "in", "b.csv", LINE)
    assert arrive(spark, tmp_path, "fmts.t") == 2
    assert sources.tables.table_facts(spark, "fmts.t")["provider"].lower() == "orc"


def test_broken_lines_are_kept_whole_counted_and_told_apart(spark, tmp_path):
    deliver(tmp_path / "in", "a.csv", LINE, LINE + ",more", "broken",
            LINE.replace("Ana", '"Ana\nMaria"'))
    read = sources.read_csv(spark, str(tmp_path / "in"))
    assert sorted(r[CORRUPT_RECORD] for r in read.collect() if r[CORRUPT_RECORD])[-1] == "broken"
    assert LINE + ",more" in {r[CORRUPT_RECORD] for r in read.collect()}
    whole = sources.read_csv(spark, str(tmp_path / "in"), multiLine="true").collect()
    assert "Ana\nMaria" in {r[NAME] for r in whole}
    for apart in (False, True):
        where = layers(f"broken_{apart}")
        sources.ensure_schema(spark, where.schema(where.bronze_schema))
        sources.append_history(spark, str(tmp_path / "in"), where.bronze)
        report = plans.refresh(spark, where, corrupt_apart=apart).get
        rows, broken = report["total_linhas"], report["registros_corrompidos"]
        assert (rows, broken) == (5, 4)
        assert sources.scan(spark, where.silver).count() == (1 if apart else 5)
        assert spark.catalog.tableExists(where.corrupt) == apart
        if apart:
            assert sources.scan(spark, where.corrupt).count() == 4


def test_silver_finds_columns_whatever_their_case(spark):
    bronze = bronze_sample(spark, SF)
    odd = bronze.toDF(*[c.upper() if k % 2 else c.title()
                        for k, c in enumerate(bronze.columns)])
    where = layers("odd_case")
    report = plans.save_silver(odd, where).get
    saved = sources.scan(spark, where.silver)
    assert saved.columns == odd.columns
    assert bag(saved) == bag(plans.refine(odd)) == bag(plans.refine(bronze))
    assert report["idade_negativa"] == operators.quality_profile(
        odd, parsed_values(), validity_rules(odd)).first()["idade_negativa"] > 0
    with pytest.raises(ValueError, match="cpf"):
        plans.save_silver(bronze.drop("cpf"), where)
    with pytest.raises(ValueError, match="cpf"):
        plans.refine(bronze.drop("cpf"))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError):
            plans.refine(odd)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_types_are_equal_for_text_and_typed_bronze(spark):
    bronze = bronze_sample(spark, SF)
    text = bronze.select(*[F.col(c).cast("string").alias(c) for c in bronze.columns])
    assert plans.refine(text).dtypes == plans.refine(bronze).dtypes
    assert bag(plans.refine(text)) == bag(plans.refine(bronze))
    odd = text.limit(1).withColumn("id_transacao", F.lit("TX-9")).withColumn(
        "idade", F.lit("30.0"))
    row = plans.refine(odd).first()
    assert (row["id_transacao"], row["idade"]) == ("TX-9", 30)


def test_both_deliveries_are_the_whole_table(spark, tmp_path):
    import __spark_entry__ as driver
    orders = spark.read.parquet(f"{SF}/orders.parquet").limit(50)
    none = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate"))
    orders.withColumn("o_orderdate", none).write.parquet(f"{tmp_path}/orders.parquet")
    first, second = driver.deliveries(spark, str(tmp_path))
    assert first.count() + second.count() == 50


def test_scratch_removes_what_is_not_kept(spark):
    with sources.Scratch(spark) as scratch:
        gone, kept = scratch.stage(spark.range(3), "a"), scratch.stage(spark.range(4), "b")
        assert gone.count() == 3
        files = [f.removeprefix("file:") for f in gone.inputFiles()]
        scratch.keep("b")
    assert not any(os.path.exists(f) for f in files)
    assert kept.count() == 4


@pytest.mark.parametrize("master", [None, "local-cluster[2,1,1024]", "yarn", "spark://x"])
def test_only_a_known_single_machine_gets_a_local_folder(master):
    class Conf:
        known = {"spark.app.id": "x"} | ({"spark.master": master} if master else {})

        def get(self, key, default=None):
            return self.known.get(key, default)

    class Session:
        conf = Conf()
    with pytest.raises(ValueError):
        sources.shared_folder(Session())
    Conf.known |= {"spark.checkpoint.dir": "file:///mnt/shared"}
    assert sources.shared_folder(Session()) == "file:///mnt/shared/lastro/x"
    Conf.known |= {"spark.lastro.localPathIsShared": "false"}
    with pytest.raises(ValueError):
        sources.shared_folder(Session())


def test_locations_may_hold_quotes_and_backslashes(spark, tmp_path):
    folder = f"{tmp_path}/it's"
    sources.ensure_schema(spark, "quoted_place", folder)
    sources.write_table(spark.range(2), "quoted_place.t")
    assert "it's" in sources.tables.table_facts(spark, "quoted_place.t")["location"]
