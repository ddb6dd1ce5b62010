"""The whole refresh: bronze table to silver table to gold tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lastro.names import NAME, Layers, quoted
from lastro.plans.gold import (
    CLIENT_COLUMNS,
    RISK_COLUMNS,
    RISK_MULTIPLIER,
    bank_indicators,
    client_summary,
)
from lastro.plans.silver import corrupt_record, refine_observed
from lastro.sources import Release, Scratch, drop_table, ensure_schema, scan, write_table
from lastro.sources.versions import schema_location


def save_silver(bronze: DataFrame, layers: Layers = Layers(),
                fmt: str | None = None, corrupt_apart: bool = False,
                **rule_options) -> Observation:
    """Clean the raw rows, save them, and report on their quality.

    The metrics of ``quality_profile`` are counted on the rows while they are
    being written and cost no further pass; ``.get`` on the result gives them
    as a dict. Writing is one stage without a shuffle, in which Spark counts
    every partition once even when its task had to be repeated.

    Rows that broken lines became are kept as transactions and counted as
    ``registros_corrompidos``. With ``corrupt_apart`` they are written, as they
    came, to ``layers.corrupt`` in place of silver; this reads bronze a second
    time. Without it, a ``layers.corrupt`` of an earlier run is dropped, since
    its rows are in silver now. The two tables are replaced one after the
    other; ``refresh_together`` replaces them at one moment.
    """
    report = Observation()
    ensure_schema(bronze.sparkSession, layers.schema(layers.silver_schema))
    clean = refine_observed(bronze, report, not corrupt_apart, **rule_options)
    write_table(clean, layers.silver, fmt=fmt)
    if corrupt_apart:
        write_table(bronze.filter(corrupt_record(bronze)), layers.corrupt, fmt=fmt)
    else:
        drop_table(bronze.sparkSession, layers.corrupt)
    return report


def save_gold(silver: DataFrame, layers: Layers = Layers(),
              multiplier: float = RISK_MULTIPLIER, fmt: str | None = None,
              key: str = NAME, where: Column | None = None,
              distinct_clients: bool = False) -> None:
    """Save the three data products from two scans of silver and one shuffle.

    The bank indicators come first, because the mean they publish is the one
    the risk threshold needs. Both per-client tables are then cut from a
    single aggregate. ``where`` limits all three, and so the mean as well;
    ``key`` tells clients apart; ``distinct_clients`` counts names once.
    """
    spark = silver.sparkSession
    ensure_schema(spark, layers.schema(layers.gold_schema))

    def write(df: DataFrame, table: str) -> DataFrame:
        write_table(df, table, fmt=fmt)
        return spark.table(table)
    _write_gold(silver, layers, write, multiplier, key, where, distinct_clients)


def _write_gold(silver: DataFrame, layers: Layers,
                write: Callable[[DataFrame, str], DataFrame], multiplier: float,
                key: str, where: Column | None, distinct_clients: bool) -> None:
    spark = silver.sparkSession
    bank = write(bank_indicators(silver, distinct_clients, where), layers.bank_indicators)
    threshold = bank.select(F.col("media_transacoes") * multiplier).scalar()
    with Scratch(spark) as scratch:  # the summary holds client names
        summary = scratch.stage(
            client_summary(silver, threshold, key, where), "client-summary")
        client = quoted(key)
        write(summary.select(client, *CLIENT_COLUMNS), layers.client_view)
        write(summary.select(client, *RISK_COLUMNS), layers.risk_monitor)


def refresh(spark: SparkSession, layers: Layers = Layers(),
            multiplier: float = RISK_MULTIPLIER, fmt: str | None = None,
            key: str = NAME, where: Column | None = None,
            distinct_clients: bool = False, corrupt_apart: bool = False,
            **rule_options) -> Observation:
    """Rebuild silver from all of bronze, then gold from silver."""
    report = save_silver(scan(spark, layers.bronze), layers, fmt, corrupt_apart,
                         **rule_options)
    save_gold(scan(spark, layers.silver), layers, multiplier, fmt, key, where,
              distinct_clients)
    return report


def refresh_together(spark: SparkSession, layers: Layers = Layers(),
                     multiplier: float = RISK_MULTIPLIER, fmt: str = "parquet",
                     key: str = NAME, where: Column | None = None,
                     distinct_clients: bool = False, corrupt_apart: bool = False,
                     keep: int = 2, **rule_options) -> Observation:
    """``refresh`` with all tables of silver and gold switched at one moment.

    Silver, the rows of broken lines and the three data products are written
    as one version and become visible by one commit: a reader sees the old or
    the new and never a half-written table, and ``sources.snapshot`` gives all
    of one refresh. Without
    ``corrupt_apart`` the new version of ``layers.corrupt`` is empty. All five
    are views from then on; tables of these names must be dropped first. The
    ``keep`` newest versions stay, older ones are removed. Files lie beside the
    silver schema's tables, in ``versoes``.
    """
    for schema in (layers.silver_schema, layers.gold_schema):
        ensure_schema(spark, layers.schema(schema))
    release = Release(
        spark, f"{schema_location(spark, layers.schema(layers.silver_schema))}/versoes", fmt)
    bronze, report = scan(spark, layers.bronze), Observation()
    silver = release.write(
        refine_observed(bronze, report, not corrupt_apart, **rule_options), layers.silver)
    apart = corrupt_record(bronze) if corrupt_apart else F.lit(False)
    release.write(bronze.filter(apart), layers.corrupt)
    _write_gold(silver, layers, release.write, multiplier, key, where, distinct_clients)
    release.commit()
    release.clean(keep)
    return report
