"""Tables replaced at one moment, and what readers see meanwhile."""

import threading

import pytest
from pyspark.sql import functions as F

from lastro import plans, sources
from lastro.names import Layers
from lastro.plans.medallion import save_silver
from lastro.sources import Release
from lastro.sources.versions import VERSION, folders, read_log, schema_location
from tests.test_tables import LINE, bag, deliver

BROKEN = "3,too,short"


def bronze(spark, tmp_path, name, *lines):
    layers = Layers(f"{name}_bronze", f"{name}_silver", f"{name}_gold")
    sources.ensure_schema(spark, layers.schema(layers.bronze_schema))
    deliver(tmp_path / name, "a.csv", *lines)
    sources.append_history(spark, str(tmp_path / name), layers.bronze)
    return layers


def home(spark, layers):
    return f"{schema_location(spark, layers.schema(layers.silver_schema))}/versoes"


def parts(spark, layers):
    silver = spark.table(layers.silver)
    return silver.count(), spark.table(layers.corrupt).count()


def test_all_tables_are_those_of_a_plain_refresh(spark, tmp_path):
    lines = [LINE, LINE.replace("Ana", "Bia").replace("10.50", "900"), BROKEN]
    one = bronze(spark, tmp_path, "together", *lines)
    two = bronze(spark, tmp_path, "apart", *lines)
    for _ in range(3):
        report = plans.refresh_together(spark, one, corrupt_apart=True).get
    assert report == plans.refresh(spark, two, corrupt_apart=True).get
    for product in ("silver", "corrupt", "client_view", "bank_indicators", "risk_monitor"):
        own, plain = (spark.table(getattr(x, product)) for x in (one, two))
        drop = ["_ingerido_em", "_arquivo_origem"]
        assert own.dtypes == plain.dtypes
        assert bag(own.drop(*drop)) == bag(plain.drop(*drop))
    assert parts(spark, one) == (2, 1)


def test_broken_rows_are_in_one_place_in_either_order(spark, tmp_path):
    layers = bronze(spark, tmp_path, "either", LINE, BROKEN)
    for apart in (True, False, True):
        plans.refresh_together(spark, layers, corrupt_apart=apart)
        assert parts(spark, layers) == ((1, 1) if apart else (2, 0))


def test_a_stale_table_of_broken_rows_is_dropped(spark, tmp_path):
    layers = bronze(spark, tmp_path, "stale", LINE, BROKEN)
    rows = spark.table(layers.bronze)
    save_silver(rows, layers, corrupt_apart=True)
    assert parts(spark, layers) == (1, 1)
    save_silver(rows, layers)
    assert spark.table(layers.silver).count() == 2
    assert not spark.catalog.tableExists(layers.corrupt)
    save_silver(rows, layers, corrupt_apart=True)
    assert parts(spark, layers) == (1, 1)


def test_nothing_is_seen_before_the_commit(spark):
    sources.ensure_schema(spark, "unseen")
    folder = f"{schema_location(spark, 'unseen')}/versoes"
    first = Release(spark, folder)
    first.write(spark.range(3), "unseen.a")
    first.write(spark.range(30), "unseen.b")
    assert not spark.catalog.tableExists("unseen.a")
    first.commit()
    counts = lambda s: (s.table("unseen.a").count(), s.table("unseen.b").count())
    assert counts(spark) == (3, 30)
    second = Release(spark, folder)
    assert second.write(spark.range(5), "unseen.a").count() == 5
    second.write(spark.range(50), "unseen.b")
    assert counts(spark) == counts(spark.newSession()) == (3, 30)
    lost = Release(spark, folder)  # a writer that dies
    lost.write(spark.range(7), "unseen.a")
    second = Release(spark, folder)
    second.write(spark.range(6), "unseen.a")
    second.write(spark.range(60), "unseen.b")
    second.commit()
    assert counts(spark) == counts(spark.newSession()) == (6, 60)
    assert lost.version in second.clean(keep=1)
    assert counts(spark) == (6, 60)
    left = [p for t in folders(spark, folder) for s in folders(spark, t)
            for p in folders(spark, s) if VERSION in p]
    assert len(left) == 2 and all(str(second.version) in p for p in left)


def test_a_reader_meets_whole_refreshes_only(spark, tmp_path):
    layers = bronze(spark, tmp_path, "readers", LINE, LINE.replace("1,Ana", "2,Bia"), BROKEN)
    plans.refresh_together(spark, layers)
    seen, alone, stop, failed = [], [], threading.Event(), []
    session, folder = spark.newSession(), home(spark, layers)

    def read():
        while not stop.is_set():
            try:
                alone.append(session.table(layers.silver).count())
                tables = sources.snapshot(session, folder)
                seen.append((tables[layers.silver].count(), tables[layers.corrupt].count(),
                             tables[layers.bank_indicators].first()["qnt_transacoes"]))
            except Exception as error:  # noqa: BLE001
                failed.append(error)
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for apart in (True, False, True):
            plans.refresh_together(spark, layers, corrupt_apart=apart, keep=9)
    finally:
        stop.set()
        reader.join()
    assert not failed
    assert set(seen) == {(3, 0, 3), (2, 1, 2)} and set(alone) == {3, 2}


def test_types_may_change_between_versions(spark, tmp_path):
    layers = bronze(spark, tmp_path, "types", LINE)
    amount = lambda: dict(spark.table(layers.silver).dtypes)["valor_transacao"]
    for kind in ("float", "decimal(18,2)", "float"):
        plans.refresh_together(spark, layers, money_type=kind)
        assert amount() == kind and spark.table(layers.silver).count() == 1


def test_old_versions_are_removed_and_never_listed(spark, tmp_path):
    layers = bronze(spark, tmp_path, "old", LINE)
    for _ in range(4):
        plans.refresh_together(spark, layers, keep=2)
    table = next(p for p in folders(spark, home(spark, layers))
                 if p.endswith("pr_transacoes_bancarias"))
    kept = folders(spark, folders(spark, table)[0])
    assert len(kept) == 2
    assert read_log(spark, home(spark, layers)).select(VERSION).distinct().count() == 4
    plan = spark.table(layers.silver)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({VERSION}" in plan and "Subquery" in plan


def test_tables_and_other_formats_are_refused(spark, tmp_path):
    layers = bronze(spark, tmp_path, "taken", LINE)
    plans.refresh(spark, layers)
    with pytest.raises(ValueError, match="is a table"):
        plans.refresh_together(spark, layers)
    assert spark.table(layers.silver).count() == 1
    with pytest.raises(ValueError, match="by itself"):
        Release(spark, home(spark, layers), "delta")


def test_empty_tables_and_odd_columns(spark):
    sources.ensure_schema(spark, "odd")
    release = Release(spark, f"{schema_location(spark, 'odd')}/versoes")
    release.write(spark.range(0).withColumn("a b`c", F.lit("x")), "odd.t")
    release.commit()
    assert spark.table("odd.t").columns == ["id", "a b`c"]
    assert spark.table("odd.t").count() == 0
