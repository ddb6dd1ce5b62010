"""CSV deliveries and the append-only bronze history made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.names import (
    CORRUPT_RECORD,
    DELIVERY_SCHEMA,
    INGESTED_AT,
    SOURCE_FILE,
)
from lastro.sources.tables import (
    has_stream_log,
    is_file_format,
    table_facts,
    write_table,
)

# The schema is given, so no pass is spent on inferring it. Headers are
# checked against it in each file, because a reordered file would otherwise
# be read into the wrong columns. Records keep to one line each, so that
# large files split; with ``multiLine="true"`` a quoted value may hold line
# ends, and each file is then read by one task.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false"}


def read_csv(spark: SparkSession, paths: str | Sequence[str],
             schema: str = DELIVERY_SCHEMA, **options: str) -> DataFrame:
    """Delivered files as text columns.

    A line with more or fewer fields than the schema stays whole in
    ``_registro_corrompido``, as in the history; its other columns hold what
    could be read of it.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    return traceable(spark.read, schema, **options).csv(paths)


def traceable(reader, schema: str = DELIVERY_SCHEMA, **options: str):
    """A batch or stream reader set up to keep what a plain read would lose:
    lines with too many or too few fields are kept whole in their own column.
    """
    return (reader.options(**{**CSV_OPTIONS, **options})
            .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
            .schema(f"{schema}, {CORRUPT_RECORD} STRING"))


def with_origin(df: DataFrame) -> DataFrame:
    """Adds the file each row came from and the time it was loaded."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT))


def refuse_stream_table(spark: SparkSession, table: str) -> None:
    """Stop before rows are appended that a stream's log would hide."""
    facts = table_facts(spark, table)
    if (facts and is_file_format(facts.get("provider", ""))
            and has_stream_log(spark, facts["location"])):
        raise ValueError(f"{table} is written by ingest_arrivals; rows appended to "
                         "it would not be seen")


def append_history(spark: SparkSession, paths: str | Sequence[str], table: str,
                   schema: str = DELIVERY_SCHEMA, fmt: str | None = None,
                   **options: str) -> None:
    """Add delivered files to the bronze history; earlier rows stay as they are.

    Every call loads every file it is given. To load only files not yet
    loaded, use ``load_deliveries`` or ``lastro.streaming.ingest_arrivals``. A file-based table that
    was written by it is refused before anything is written: its readers see
    only the files in the stream's log, and would never see these rows.
    """
    refuse_stream_table(spark, table)
    paths = paths if isinstance(paths, str) else list(paths)
    raw = traceable(spark.read, schema, **options).csv(paths)
    write_table(with_origin(raw), table, mode="append", fmt=fmt)
