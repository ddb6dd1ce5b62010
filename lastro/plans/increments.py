"""Gold from states kept by delivery, without reading old rows again.

A delivery is reduced once to two small tables. ``clientes`` has, for each
client and band of amounts, counts, the total and the last date: all that the
financial view and the bank's indicators need, and mergeable by adding up.
``valores`` has each client's amounts with how often they occur, in order of
their bands. The risk threshold moves with every delivery; to count again what
lies above it, whole bands are added up, and amounts are read only in the one
band that the threshold cuts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StringType, StructField, StructType

from lastro.names import (
    AMOUNT,
    CANCELLED,
    DATE,
    INGESTED_AT,
    KIND,
    NAME,
    PIX,
    SOURCE_FILE,
    STATUS,
    Layers,
    quoted,
)
from lastro.plans.gold import BANK_COLUMNS, CLIENT_COLUMNS, RISK_COLUMNS, RISK_MULTIPLIER
from lastro.operators import quality_metrics
from lastro.plans.silver import parsed_values, refine, validity_rules
from lastro.sources import Scratch, ensure_schema, read_ledger, scan, write_table
from lastro.sources.ledger import LOADED, RECEIVED
from lastro.sources.scratch import remove
from lastro.sources.versions import folders, schema_location

DELIVERY = "entrega"
#: Bands of amounts for each doubling; a band holds amounts that differ by less.
BANDS = 4
#: The delivery that compacted states are of.
EARLIER = "anteriores"


def band(amount: Column) -> Column:
    """The band of an amount: one that is not larger is in no higher band.

    Amounts up to 1 share band 0; NULL, and NaN, which sorts above all numbers,
    have bands of their own below and above all others.
    """
    value = amount.cast("double")
    level = F.log2(F.least(F.greatest(value, F.lit(1.0)), F.lit(1e300)))
    return (F.when(value.isNull(), -1).when(F.isnan(value), 1 << 20)
            .otherwise(F.floor(BANDS * level)).cast("int"))


def _sum_type(amount: DataType) -> str:
    if isinstance(amount, DecimalType):
        return f"decimal({min(38, amount.precision + 10)},{amount.scale})"
    return "double"


def mean_of(total: Column, count: Column, amount: DataType) -> Column:
    """The mean as ``avg`` gives it, from a total and a count of such amounts.

    For decimals it is rounded once, half up, at four more places. In units of
    the last place, with |total| / count = a / b, that is the whole part of
    (2a + b) / 2b; a remainder is taken off before dividing, so that no
    division rounds.
    """
    if not isinstance(amount, DecimalType):
        return total / count
    places = amount.scale + 4
    unit = F.lit(10 ** places).cast(f"decimal({places + 1},0)")
    above = (2 * (F.abs(total).cast(f"decimal(30,{amount.scale})") * unit)
             .cast("decimal(37,0)") + count.cast("decimal(18,0)")).cast("decimal(38,0)")
    below = (2 * count).cast("decimal(19,0)")
    whole = ((above - above % below).cast("decimal(38,0)") / below).cast("decimal(38,0)")
    last = F.lit(Decimal(1).scaleb(-places)).cast(f"decimal({places},{places})")
    return (F.signum(total).cast("decimal(1,0)") * whole.cast(f"decimal({35 - places},0)")
            * last).cast(f"decimal({min(38, amount.precision + 4)},{places})")


@dataclass(frozen=True)
class States:
    """The states of one way to count: which ``key`` tells clients apart, and
    which rows count (``where``, in SQL). Another way needs another ``name``.

    They lie beside the gold schema's tables in the folder ``name``. Its newest
    finished generation holds, a delivery a partition, both states.
    """

    spark: SparkSession
    layers: Layers = Layers()
    key: str = NAME
    where: str | None = None
    name: str = "estado"

    @property
    def home(self) -> str:
        ensure_schema(self.spark, self.layers.schema(self.layers.gold_schema))
        return f"{schema_location(self.spark, self.layers.schema(self.layers.gold_schema))}" \
               f"/{self.name}"

    def _generations(self) -> list[int]:
        """The finished generations, oldest first; 0 needs no mark."""
        found = [int(m[1]) for p in folders(self.spark, f"{self.home}/prontas")
                 if (m := re.fullmatch(r".*/(\d+)", p))]
        return [0, *sorted(found)]

    def _path(self, state: str, generation: int | None = None) -> str:
        generation = self._generations()[-1] if generation is None else generation
        return f"{self.home}/{generation}/{state}"

    def read(self, state: str) -> DataFrame:
        """All deliveries of "clientes" or "valores"."""
        path = self._path(state)
        found = self.spark.read.parquet(path).schema
        return self.spark.read.schema(StructType([
            StructField(DELIVERY, StringType()) if f.name == DELIVERY else f
            for f in found])).parquet(path)

    def known(self) -> set[str]:
        """The deliveries held; compacted ones are ``EARLIER`` together."""
        held = [{p.rsplit(f"{DELIVERY}=", 1)[1] for p in folders(self.spark, self._path(s))
                 if f"/{DELIVERY}=" in p} for s in ("clientes", "valores")]
        return held[0] & held[1]

    def _replace(self, state: DataFrame, path: str, delivery: str) -> None:
        state.write.mode("overwrite").parquet(f"{path}/{DELIVERY}={delivery}")

    def fold(self, silver: DataFrame, delivery: str) -> None:
        """Take the cleaned rows of one delivery, named by letters, digits, ``-``
        and ``_``, into the states.

        Rows are read once, and shuffled once after being added up in their
        tasks. A delivery has its own partition, which a repeated or resumed
        call replaces, so nothing is counted twice. A type of amounts other
        than that of the deliveries before is refused.
        """
        if not re.fullmatch(r"[\w-]+", delivery) or delivery == EARLIER:
            raise ValueError(f"{delivery} cannot name a delivery")
        rows = silver if self.where is None else silver.filter(F.expr(self.where))
        kind = rows.schema[AMOUNT].dataType
        if self.known() and self.read("valores").schema["valor"].dataType != kind:
            raise ValueError(f"amounts are not of type {kind.simpleString()} so far")
        of_amount = (rows.groupBy(F.col(quoted(self.key)).alias("cliente"),
                                  F.col(AMOUNT).alias("valor"))
                     .agg(F.count("*").alias("n"), F.max(DATE).alias("ultima"),
                          F.count_if(F.col(STATUS) == CANCELLED).alias("canceladas"),
                          F.count_if(F.col(KIND) == PIX).alias("pix"),
                          F.count(NAME).alias("com_nome"))
                     .withColumn("faixa", band(F.col("valor"))))
        exact = isinstance(kind, DecimalType)
        total = f"decimal(38,{kind.scale})" if exact else "double"
        worth = F.col("valor") * F.col("n") if exact else F.col("valor").cast("double") * F.col("n")
        with Scratch(self.spark) as scratch:
            of_amount = scratch.stage(of_amount, "delivery-state")
            # files and row groups of one delivery cover few bands each
            self._replace(of_amount.select("cliente", "valor", "n", "faixa")
                          .where("valor IS NOT NULL").sortWithinPartitions("faixa"),
                          self._path("valores"), delivery)
            self._replace(of_amount.groupBy("cliente", "faixa").agg(
                F.sum("n").alias("n"),
                F.sum(F.when(F.col("valor").isNotNull(), F.col("n"))).alias("com_valor"),
                F.sum(worth).cast(total).alias("soma"), F.max("ultima").alias("ultima"),
                F.sum("canceladas").alias("canceladas"), F.sum("pix").alias("pix"),
                F.sum("com_nome").alias("com_nome")), self._path("clientes"), delivery)

    def compact(self) -> None:
        """Add all deliveries up into one, so that states stay small.

        That is a new generation, which readers take once both states are whole;
        the one before is then removed.
        """
        old = self._generations()[-1]
        clients = self.read("clientes")
        numbers = ("n", "com_valor", "soma", "canceladas", "pix", "com_nome")
        self._replace(clients.groupBy("cliente", "faixa").agg(
            F.max("ultima").alias("ultima"),
            *(F.sum(c).cast(clients.schema[c].dataType).alias(c) for c in numbers))
            .select(*(c for c in clients.columns if c != DELIVERY)),
            self._path("clientes", old + 1), EARLIER)
        self._replace(self.read("valores").groupBy("cliente", "valor", "faixa")
                      .agg(F.sum("n").alias("n")).select("cliente", "valor", "n", "faixa")
                      .sortWithinPartitions("faixa"), self._path("valores", old + 1), EARLIER)
        mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.home}/prontas/{old + 1}")
        mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(mark)
        remove(self.spark, f"{self.home}/{old}")

    # -- the data products, from the states ------------------------------

    def _amount(self) -> DataType:
        return self.read("valores").schema["valor"].dataType

    def bank_indicators(self) -> DataFrame:
        """As ``plans.bank_indicators`` has it over all rows."""
        clients, volume, rows, mean, pix, cancelled = BANK_COLUMNS
        amount, names = self._amount(), ("com_nome", "soma", "n", "com_valor", "pix",
                                         "canceladas")
        totals = self.read("clientes").agg(*(F.sum(c).alias(c) for c in names))
        count = lambda c: F.coalesce(c, F.lit(0))
        return totals.select(
            count("com_nome").alias(clients), F.col("soma").cast(_sum_type(amount)).alias(volume),
            count("n").alias(rows),
            mean_of(F.col("soma"), F.col("com_valor"), amount).alias(mean),
            count("pix").alias(pix), count("canceladas").alias(cancelled))

    def client_financial_view(self) -> DataFrame:
        """As ``plans.client_financial_view`` has it over all rows."""
        count, total, mean, last = CLIENT_COLUMNS
        amount = self._amount()
        return (self.read("clientes").groupBy(F.col("cliente").alias(self.key))
                .agg(F.sum("n").alias(count), F.sum("soma").alias("_soma"),
                     F.sum("com_valor").alias("_com"), F.max("ultima").alias(last))
                .select(quoted(self.key), count,
                        F.col("_soma").cast(_sum_type(amount)).alias(total),
                        mean_of(F.col("_soma"), F.col("_com"), amount).alias(mean), last))

    def risk_monitor(self, multiplier: float = RISK_MULTIPLIER) -> DataFrame:
        """As ``plans.risk_monitor`` has it over all rows.

        Amounts are read in the threshold's band only, by a filter that reaches
        the scan; what is in higher bands was counted when it came.
        """
        cancelled, high = RISK_COLUMNS
        limit = self.bank_indicators().select(
            (F.col(BANK_COLUMNS[3]) * multiplier).alias("limite"))
        threshold, own = limit.select("limite", band(F.col("limite"))).first()
        higher = F.lit(threshold is not None) & (F.col("faixa") > own)
        whole = self.read("clientes").select(
            "cliente", "canceladas", F.when(higher, F.col("com_valor")).alias("acima"))
        cut = (self.read("valores")
               .where((F.col("faixa") == own) & (F.col("valor") > F.lit(threshold)))
               .select("cliente", F.lit(0).cast("long").alias("canceladas"),
                       F.col("n").alias("acima")))
        return (whole.union(cut).groupBy(F.col("cliente").alias(self.key))
                .agg(F.sum("canceladas").alias(cancelled),
                     F.coalesce(F.sum("acima"), F.lit(0)).alias(high)))

    def save_gold(self, multiplier: float = RISK_MULTIPLIER, fmt: str | None = None) -> None:
        """Write the three data products' tables from the states."""
        write_table(self.bank_indicators(), self.layers.bank_indicators, fmt=fmt)
        write_table(self.client_financial_view(), self.layers.client_view, fmt=fmt)
        write_table(self.risk_monitor(multiplier), self.layers.risk_monitor, fmt=fmt)


def loads_after(spark: SparkSession, layers: Layers,
                taken: set[str]) -> Iterator[tuple[str, DataFrame]]:
    """(carga, its bronze rows) of each finished load of the ledger not ``taken``.

    A load's rows are those of its files that came between its two events. A
    load wrote its own files of bronze, so filters on name and time skip the
    rest of the history by its statistics.
    """
    event = F.col("situacao")
    events = read_ledger(spark, layers.ledger).where(event.isin(RECEIVED, LOADED))
    loads = (events.groupBy("carga").agg(
        F.min(F.when(event == RECEIVED, F.col("registrado_em"))).alias("begin"),
        F.max(F.when(event == LOADED, F.col("registrado_em"))).alias("end"),
        F.min("arquivo").alias("low"), F.max("arquivo").alias("high"))
        .where("begin IS NOT NULL AND end IS NOT NULL").orderBy("begin").collect())
    for load in (r for r in loads if r["carga"] not in taken):
        files = events.where((F.col("carga") == load["carga"]) & (event == LOADED)).select(
            F.col("arquivo").alias(SOURCE_FILE))
        yield load["carga"], (scan(spark, layers.bronze).where(
            F.col(SOURCE_FILE).between(load["low"], load["high"])
            & F.col(INGESTED_AT).between(load["begin"], load["end"]))
            .join(files, SOURCE_FILE, "left_semi"))


def _noted(spark: SparkSession, table: str) -> set[str]:
    if not spark.catalog.tableExists(table):
        return set()
    return {r[0] for r in scan(spark, table).select("carga").distinct().collect()}


def fold_loads(states: States, keep: int = 50, **rule_options) -> list[str]:
    """Fold every load of the ledger that the states do not hold yet; returns them.

    Beyond ``keep`` deliveries, states are compacted; the table ``<name>_cargas``
    tells which loads they hold. Rows loaded without a ledger are in no load.
    One caller at a time.
    """
    spark, layers = states.spark, states.layers
    table = layers.table(layers.gold_schema, f"{states.name}_cargas")
    folded = []
    for load, rows in loads_after(spark, layers, _noted(spark, table)):
        states.fold(refine(rows, **rule_options), load)
        write_table(spark.createDataFrame([(load,)], "carga STRING").coalesce(1),
                    table, mode="append")
        folded.append(load)
    if len(states.known()) > keep:
        states.compact()
    return folded


def profile_loads(spark: SparkSession, layers: Layers = Layers()) -> list[str]:
    """Add the quality of every load not profiled yet to ``layers.quality``.

    One row a file and load, with the metrics of ``quality_metrics`` over its
    raw rows: the history of what was missing, unreadable or broken, delivery
    by delivery. Each load is read once, and added up in its tasks. Returns the
    loads; one that was interrupted is profiled by the next call, as its rows
    are written together.
    """
    profiled = []
    for load, rows in loads_after(spark, layers, _noted(spark, layers.quality)):
        columns = [c for c in rows.columns if c != SOURCE_FILE]
        found = rows.groupBy(SOURCE_FILE).agg(*quality_metrics(
            columns, parsed_values(), validity_rules(rows)))
        write_table(found.withColumn("carga", F.lit(load)), layers.quality, mode="append")
        profiled.append(load)
    return profiled
