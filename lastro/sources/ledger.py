"""Deliveries judged file by file, and a ledger of what became of each.

The ledger is a table of events, only ever added to. A file's events tell
whether it was loaded, is a copy of what was loaded, has changed since, or was
put aside because its header is another one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lastro.names import DELIVERY_SCHEMA, INGESTED_AT, SOURCE_FILE
from lastro.sources.deliveries import CSV_OPTIONS, refuse_stream_table, traceable, with_origin
from lastro.sources.scratch import Scratch
from lastro.sources.tables import write_table

LEDGER_SCHEMA = ("arquivo STRING, tamanho BIGINT, modificado_em TIMESTAMP, linhas BIGINT, "
                 "impressao STRING, situacao STRING, motivo STRING, carga STRING, "
                 "registrado_em TIMESTAMP")
#: Events of the ledger. Files that it already knows as they are get no event.
RECEIVED, LOADED, ASIDE, COPY, CHANGED = (
    "recebido", "carregado", "quarentena", "copia", "alterado")
NEW = "novo"

_LISTING = ("pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")
_LINE = ("sep", "delimiter", "quote", "escape", "ignoreLeadingWhiteSpace",
         "ignoreTrailingWhiteSpace")


def _chosen(options: dict[str, str], names: Sequence[str]) -> dict[str, str]:
    wanted = {n.lower() for n in names}
    return {k: v for k, v in options.items() if k.lower() in wanted}


def list_files(spark: SparkSession, paths: str | Sequence[str], **options: str) -> DataFrame:
    """(arquivo, tamanho, modificado_em) of the files at ``paths``; none is opened,
    and files of no bytes are left out."""
    paths = paths if isinstance(paths, str) else list(paths)
    files = spark.read.format("binaryFile").options(**_chosen(options, _LISTING)).load(paths)
    return files.select(F.col("_metadata.file_path").alias("arquivo"),
                        F.col("_metadata.file_size").alias("tamanho"),
                        F.col("_metadata.file_modification_time").alias("modificado_em"))


def as_paths(files: Sequence[str]) -> list[str]:
    """File URIs as paths that a reader takes for these files, not for patterns."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(f)) for f in files]


def inspect_files(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """(arquivo, linhas, impressao, cabecalho) of each of ``files`` with a line.

    ``impressao`` tells contents apart: the number of lines, and a sum and an
    exclusive or of their hashes. The order of lines does not matter, so parts
    of one file are summed wherever they are read, and no file is held whole.
    """
    lines = spark.read.text(as_paths(files)).select(
        "value", F.col("_metadata.file_path").alias("arquivo"),
        (F.col("_metadata.file_block_start") == 0).alias("_first"),
        F.monotonically_increasing_id().alias("_row"))
    line = F.col("value")
    return (lines.groupBy("arquivo").agg(
        F.count("*").alias("linhas"),
        F.concat_ws(":", F.count("*"), F.sum(F.xxhash64(line).cast("decimal(38,0)")),
                    F.bit_xor(F.xxhash64(line, F.lit(1)))).alias("impressao"),
        F.min_by("value", F.when(F.col("_first"), F.col("_row"))).alias("cabecalho")))


def fits_header(spark: SparkSession, first_line: Column, schema: str = DELIVERY_SCHEMA,
                **options: str) -> Column:
    """Whether a file's first line names the columns of ``schema`` in order.

    Names compare as the session compares them. A file without lines, or one
    read without headers, fits.
    """
    options = {**CSV_OPTIONS, **options}
    if options["header"].lower() != "true":
        return F.lit(True)
    names = StructType.fromDDL(schema).fieldNames()
    fields = ", ".join(f"c{k} STRING" for k in range(len(names) + 1))
    found = F.from_csv(first_line, fields, _chosen(options, _LINE))
    exact = spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    fold = (lambda c: c) if exact else F.lower
    fits = found[f"c{len(names)}"].isNull()
    for k, name in enumerate(names):
        fits = fits & fold(found[f"c{k}"]).eqNullSafe(fold(F.lit(name)))
    return first_line.isNull() | fits


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All events so far; none when there is no ledger yet."""
    if spark.catalog.tableExists(ledger):
        return spark.table(ledger)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def _record(files: DataFrame, ledger: str, event: str | Column, load: str,
            fmt: str | None) -> None:
    event = F.lit(event) if isinstance(event, str) else event
    columns = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
    write_table(files.withColumns({"situacao": event, "carga": F.lit(load),
                                   "registrado_em": F.current_timestamp()})
                .select(*columns).coalesce(1), ledger, mode="append", fmt=fmt)


def _finish_interrupted(spark: SparkSession, table: str, ledger: str,
                        fmt: str | None) -> None:
    """Complete the ledger of a load that ended between its two writes.

    Rows of a load appear in the history together, so one row of it tells that
    all are there. Without any, its files are simply not loaded yet.
    """
    events = read_ledger(spark, ledger)
    done = events.where(F.col("situacao") == LOADED).select("carga").distinct()
    open_ = events.where(F.col("situacao") == RECEIVED).join(done, "carga", "left_anti")
    loads = [r[0] for r in open_.select("carga").distinct().collect()]
    if not loads or not spark.catalog.tableExists(table):
        return
    rows = spark.table(table).select(F.col(SOURCE_FILE).alias("arquivo"),
                                     F.col(INGESTED_AT).alias("_at"))
    present = (rows.join(open_.select("arquivo", "carga", "registrado_em"), "arquivo")
               .where("_at >= registrado_em").select("carga").distinct())
    for load in sorted(r[0] for r in present.collect()):
        _record(open_.where(F.col("carga") == load), ledger, LOADED, load, fmt)


def judge(seen: DataFrame, events: DataFrame, load_changed: bool = False) -> DataFrame:
    """``seen`` files with what each is: ``situacao`` and ``motivo``.

    A file is put aside for its header; otherwise a copy if its content was
    loaded, or will be from an earlier name in this delivery; changed if its
    path was loaded with other content; else new.
    """
    loaded = events.where(F.col("situacao") == LOADED)
    by_content = loaded.groupBy("impressao").agg(F.min("arquivo").alias("_original"))
    by_path = loaded.select("arquivo").distinct().withColumn("_path", F.lit(True))
    fits, changed = F.col("cabecalho_certo"), F.coalesce("_path", F.lit(False))
    will_load = fits if load_changed else fits & ~changed
    first = F.first("arquivo").over(
        Window.partitionBy("impressao", will_load).orderBy("arquivo"))
    here = F.when(will_load & (first != F.col("arquivo")), first)
    kind = (F.when(~fits, ASIDE).when(F.col("_original").isNotNull(), COPY)
            .when(changed, CHANGED).otherwise(NEW))
    why = (F.when(~fits, F.concat(F.lit("cabeçalho diferente: "),
                                  F.substring("cabecalho", 1, 500)))
           .when(F.col("situacao") == COPY, F.concat(F.lit("conteúdo de "), "_original"))
           .when(F.col("situacao") == CHANGED, F.lit("conteúdo novo em caminho carregado")))
    return (seen.join(by_content, "impressao", "left").join(by_path, "arquivo", "left")
            .withColumn("_original", F.coalesce("_original", here))
            .withColumn("situacao", kind).withColumn("motivo", why)
            .drop("_original", "_path"))


def load_deliveries(spark: SparkSession, paths: str | Sequence[str], table: str, ledger: str,
                    schema: str = DELIVERY_SCHEMA, fmt: str | None = None,
                    load_changed: bool = False, **options: str) -> DataFrame:
    """Add the files at ``paths`` that are not in the history yet.

    Returns (arquivo, tamanho, linhas, situacao, motivo) of the files that this
    call looked into. Whatever ``situacao`` is not "carregado" was not loaded:

    * "quarentena": the header is not that of ``schema``. All other files are
      loaded. A corrected file is loaded the next time, under any name.
    * "copia": the same lines were loaded, or are, from another file.
    * "alterado": the path was loaded before with other lines. ``load_changed``
      adds these; rows are never taken away.

    Files that the ledger knows by path, size and time are not opened again, so
    a call repeated with the whole folder reads what is new, and twice the same
    delivery adds no row. A call that was interrupted is completed by the next:
    files are noted as received, then their rows are added in one write, then
    noted as loaded. One ledger belongs to one table and one caller at a time.

    A header is judged by each file's first line, contents by all lines, both
    in the one pass over the new files that precedes their loading. The driver
    holds the paths of new files, as Spark's own listing does. A file that
    cannot be read at all, such as a broken archive, stops the call.
    """
    refuse_stream_table(spark, table)
    _finish_interrupted(spark, table, ledger, fmt)
    events = read_ledger(spark, ledger)
    with Scratch(spark) as scratch:
        at = ["arquivo", "tamanho", "modificado_em"]
        listed = list_files(spark, paths, **options)
        known = events.where(F.col("situacao") != RECEIVED).select(*at)
        fresh = scratch.stage(listed.join(known.distinct(), at, "left_anti"), "fresh")
        files = [r[0] for r in fresh.select("arquivo").collect()]
        if not files:
            return spark.createDataFrame([], "arquivo STRING, tamanho BIGINT, linhas BIGINT, "
                                             "situacao STRING, motivo STRING")
        seen = fresh.join(inspect_files(spark, files), "arquivo", "left")
        seen = seen.withColumns({
            "linhas": F.coalesce("linhas", F.lit(0)),
            "impressao": F.coalesce("impressao", F.lit("0")),
            "cabecalho_certo": fits_header(spark, F.col("cabecalho"), schema, **options)})
        judged = scratch.stage(judge(scratch.stage(seen, "seen"), events,
                                     load_changed), "judged")
        wanted = [NEW, CHANGED] if load_changed else [NEW]
        taken = judged.where(F.col("situacao").isin(wanted))
        chosen = sorted(r[0] for r in taken.select("arquivo").collect())
        load = uuid.uuid4().hex
        if chosen:
            _record(taken, ledger, RECEIVED, load, fmt)
            rows = traceable(spark.read, schema, **{
                k: v for k, v in options.items() if k not in _chosen(options, _LISTING)})
            write_table(with_origin(rows.csv(as_paths(chosen))), table, mode="append", fmt=fmt)
        final = F.when(F.col("situacao").isin(wanted), LOADED).otherwise(F.col("situacao"))
        _record(judged, ledger, final, load, fmt)
        result = scratch.stage(judged.select(
            "arquivo", "tamanho", "linhas", final.alias("situacao"), "motivo"), "report")
        scratch.keep("report")
        return result
