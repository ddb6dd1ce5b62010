"""Deliveries judged by file, and the ledger that keeps rows from coming twice."""

import gzip
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lastro import sources, streaming
from lastro.names import SOURCE_FILE, Layers
from lastro.sources import ledger
from tests.test_tables import HEADER, LINE, deliver

SWAPPED = HEADER.replace("cpf,idade", "idade,cpf")


def where(spark, name):
    layers = Layers(f"{name}_bronze")
    sources.ensure_schema(spark, layers.schema(layers.bronze_schema))
    return layers


def load(spark, layers, *folders, **options):
    """By name, what became of each file; and the rows of the history."""
    found = sources.load_deliveries(
        spark, [str(f) for f in folders], layers.bronze, layers.ledger, **options)
    rows = spark.table(layers.bronze).count() if spark.catalog.tableExists(layers.bronze) else 0
    return {r["arquivo"].rsplit("/", 1)[1]: r["situacao"] for r in found.collect()}, rows


def test_a_wrong_header_keeps_out_its_own_file_only(spark, tmp_path):
    layers = where(spark, "aside")
    deliver(tmp_path / "in", "good.csv", LINE, LINE)
    deliver(tmp_path / "in", "bad.csv", LINE, header=SWAPPED)
    assert load(spark, layers, tmp_path / "in") == (
        {"good.csv": "carregado", "bad.csv": "quarentena"}, 2)
    assert load(spark, layers, tmp_path / "in") == ({}, 2)
    listed = sources.read_ledger(spark, layers.ledger).where("situacao = 'quarentena'").first()
    assert listed["arquivo"].endswith("/bad.csv") and SWAPPED in listed["motivo"]
    # the corrected file is loaded, under the same name
    deliver(tmp_path / "in", "bad.csv", LINE.replace("Ana", "Bia"))
    assert load(spark, layers, tmp_path / "in") == ({"bad.csv": "carregado"}, 3)


@pytest.mark.parametrize("header", [
    HEADER + ",mais", HEADER.rsplit(",", 1)[0], HEADER.replace(",", ";"), LINE, "", "x"])
def test_other_headers(spark, tmp_path, header):
    layers = where(spark, "headers" + str(abs(hash(header))))
    deliver(tmp_path / "in", "bad.csv", LINE, header=header)
    assert load(spark, layers, tmp_path / "in") == ({"bad.csv": "quarentena"}, 0)


def test_headers_that_fit(spark, tmp_path):
    layers = where(spark, "fitting")
    deliver(tmp_path / "in", "upper.csv", LINE, header=HEADER.upper())
    quoted = ",".join(f'"{c}"' for c in HEADER.split(","))
    deliver(tmp_path / "in", "quoted.csv", LINE.replace("Ana", "Bia"), header=quoted)
    with gzip.open(tmp_path / "in" / "packed.csv.gz", "wt") as file:
        file.write(f"{HEADER}\r\n{LINE.replace('Ana', 'Eva')}\r\n")
    found, rows = load(spark, layers, tmp_path / "in")
    assert set(found.values()) == {"carregado"} and rows == 3
    assert load(spark, layers, tmp_path / "in") == ({}, 3)


def test_files_without_headers(spark, tmp_path):
    layers = where(spark, "headless")
    deliver(tmp_path / "in", "a.csv", header=LINE)
    assert load(spark, layers, tmp_path / "in", header="false") == ({"a.csv": "carregado"}, 1)


def test_one_delivery_twice_adds_no_row(spark, tmp_path):
    layers = where(spark, "twice_ledger")
    for folder in ("d1", "d2"):
        deliver(tmp_path / folder, "a.csv", LINE, LINE)
    assert load(spark, layers, tmp_path / "d1") == ({"a.csv": "carregado"}, 2)
    assert load(spark, layers, tmp_path / "d1") == ({}, 2)
    assert load(spark, layers, tmp_path / "d2") == ({"a.csv": "copia"}, 2)
    # copies within one delivery: the first by name is loaded
    layers = where(spark, "copies_ledger")
    assert load(spark, layers, tmp_path / "d1", tmp_path / "d2")[1] == 2
    events = sources.read_ledger(spark, layers.ledger).groupBy("situacao").count().collect()
    assert {tuple(r) for r in events} == {("recebido", 1), ("carregado", 1), ("copia", 1)}


def test_a_file_touched_but_not_changed_is_a_copy(spark, tmp_path):
    layers = where(spark, "touched")
    deliver(tmp_path / "in", "a.csv", LINE)
    load(spark, layers, tmp_path / "in")
    import os
    os.utime(tmp_path / "in" / "a.csv", (10**9, 10**9))
    assert load(spark, layers, tmp_path / "in") == ({"a.csv": "copia"}, 1)
    assert load(spark, layers, tmp_path / "in") == ({}, 1)


def test_changed_content_is_reported_and_loaded_on_request(spark, tmp_path):
    layers = where(spark, "changed")
    deliver(tmp_path / "in", "a.csv", LINE)
    load(spark, layers, tmp_path / "in")
    deliver(tmp_path / "in", "a.csv", LINE.replace("Ana", "Bia"), LINE)
    assert load(spark, layers, tmp_path / "in") == ({"a.csv": "alterado"}, 1)
    # its content under a new name is not taken for a copy of what was not loaded
    deliver(tmp_path / "in", "b.csv", LINE.replace("Ana", "Bia"), LINE)
    assert load(spark, layers, tmp_path / "in") == ({"b.csv": "carregado"}, 3)
    deliver(tmp_path / "in", "a.csv", LINE.replace("Ana", "Eva"))
    assert load(spark, layers, tmp_path / "in", load_changed=True) == (
        {"a.csv": "carregado"}, 4)
    deliver(tmp_path / "in", "a.csv", LINE.replace("Ana", "Zoe"))
    deliver(tmp_path / "in", "c.csv", LINE.replace("Ana", "Zoe"))
    assert load(spark, layers, tmp_path / "in") == (
        {"a.csv": "alterado", "c.csv": "carregado"}, 5)


def test_the_order_of_lines_makes_no_other_content(spark, tmp_path):
    layers = where(spark, "order")
    other = LINE.replace("Ana", "Bia")
    deliver(tmp_path / "in", "a.csv", LINE, other)
    deliver(tmp_path / "in", "b.csv", other, LINE)
    deliver(tmp_path / "in", "c.csv", other, LINE, LINE)
    found, rows = load(spark, layers, tmp_path / "in")
    assert found == {"a.csv": "carregado", "b.csv": "copia", "c.csv": "carregado"}
    assert rows == 5


def test_awkward_names_and_empty_files(spark, tmp_path):
    layers = where(spark, "awkward_files")
    for number, name in enumerate(("a [1].csv", "b%20{x}.csv", "ç*?.csv")):
        deliver(tmp_path / "in", name, LINE.replace("Ana", f"N{number}"))
    (tmp_path / "in" / "empty.csv").write_text("")
    deliver(tmp_path / "in", "header only.csv")
    found, rows = load(spark, layers, tmp_path / "in")
    # a file of no bytes is not listed
    assert set(found.values()) == {"carregado"} and len(found) == 4 and rows == 3
    assert spark.table(layers.bronze).select(SOURCE_FILE).distinct().count() == 3
    assert load(spark, layers, tmp_path / "in") == ({}, 3)


def interrupted(spark, tmp_path, layers, monkeypatch, failing):
    """A load whose ``failing``-th write to a table does not happen."""
    written = []

    def write(df, table, **options):
        written.append(table)
        if len(written) == failing:
            raise OSError("lost")
        sources.write_table(df, table, **options)
    with monkeypatch.context() as patch:
        patch.setattr(ledger, "write_table", write)
        with pytest.raises(OSError, match="lost"):
            load(spark, layers, tmp_path / "in")


@pytest.mark.parametrize("failing", [1, 2, 3])
def test_an_interrupted_load_is_completed_once(spark, tmp_path, monkeypatch, failing):
    layers = where(spark, f"interrupted{failing}")
    deliver(tmp_path / "in", "a.csv", LINE)
    load(spark, layers, tmp_path / "in")
    deliver(tmp_path / "in", "b.csv", LINE.replace("Ana", "Bia"))
    deliver(tmp_path / "in", "bad.csv", LINE, header=SWAPPED)
    interrupted(spark, tmp_path, layers, monkeypatch, failing)
    for _ in range(2):
        _, rows = load(spark, layers, tmp_path / "in")
        assert rows == 2
    events = sources.read_ledger(spark, layers.ledger)
    assert events.where("situacao = 'carregado'").select("arquivo").distinct().count() == 2
    assert events.where("situacao = 'quarentena'").count() == 1


def test_a_stream_table_is_refused(spark, tmp_path):
    layers = where(spark, "streamed")
    deliver(tmp_path / "in", "a.csv", LINE)
    streaming.ingest_arrivals(spark, str(tmp_path / "in"), layers.bronze, str(tmp_path / "log"))
    with pytest.raises(ValueError, match="would not be seen"):
        load(spark, layers, tmp_path / "in")


def test_new_files_alone_are_opened(spark, tmp_path, monkeypatch):
    layers = where(spark, "opened")
    deliver(tmp_path / "in", "a.csv", LINE)
    load(spark, layers, tmp_path / "in")
    deliver(tmp_path / "in", "b.csv", LINE, LINE)
    opened, inspect = [], ledger.inspect_files
    monkeypatch.setattr(ledger, "inspect_files",
                        lambda s, files: opened.extend(files) or inspect(s, files))
    load(spark, layers, tmp_path / "in")
    assert [f.rsplit("/", 1)[1] for f in opened] == ["b.csv"]


def test_contents_are_summed_over_parts_of_a_file(spark, tmp_path):
    deliver(tmp_path / "in", "a.csv", *[LINE.replace("1,Ana", f"{k},Ana") for k in range(4000)])
    file = [f"file://{tmp_path}/in/a.csv"]
    whole = ledger.inspect_files(spark, file).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        parts = ledger.inspect_files(spark, file)
        assert parts.collect() == whole
        assert whole[0]["linhas"] == 4001 and whole[0]["cabecalho"] == HEADER
        read = spark.read.text(file).select(F.spark_partition_id()).distinct().count()
        assert read > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_are_those_of_append_history(spark, tmp_path):
    layers = where(spark, "same_rows")
    deliver(tmp_path / "in", "a.csv", LINE, "3,too,short", LINE + ",too,long")
    load(spark, layers, tmp_path / "in")
    sources.append_history(spark, str(tmp_path / "in"), "same_rows_bronze.plain")
    one, two = (spark.table(t).drop("_ingerido_em") for t in (layers.bronze,
                                                             "same_rows_bronze.plain"))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))
