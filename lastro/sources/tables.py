"""Catalog tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan(spark: SparkSession, table: str) -> DataFrame:
    """All columns of a table; what the query does not use is never read."""
    return spark.table(table)


def ensure_schema(spark: SparkSession, schema: str,
                  location: str | None = None) -> None:
    """Create the schema when missing; writing into a missing one fails."""
    where = ""
    if location is not None:
        escaped = location.replace("\\", "\\\\").replace("'", "\\'")
        where = f" LOCATION '{escaped}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{where}")


def table_facts(spark: SparkSession, table: str) -> dict[str, str]:
    """Provider and location of a table; nothing when there is no such table."""
    if not spark.catalog.tableExists(table):
        return {}
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r[0].lower(): r[1] for r in rows if r[0] in ("Provider", "Location")}


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table, if there is one of this name; views stay."""
    if table_facts(spark, table).get("provider"):
        spark.sql(f"DROP TABLE {table}")


def _exists(spark: SparkSession, path: str, pattern: str = "") -> bool:
    """Whether a folder, or something in it that fits ``pattern``, exists."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not pattern:
        return bool(store.exists(folder))
    found = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, pattern))
    return found is not None and len(found) > 0


def has_stream_log(spark: SparkSession, location: str) -> bool:
    """Whether a file stream wrote this folder: readers then see only the files
    that its log names."""
    return _exists(spark, f"{location}/_spark_metadata")


def has_files(spark: SparkSession, location: str) -> bool:
    return _exists(spark, location, "[^_.]*")


def has_checkpoint(spark: SparkSession, checkpoint: str) -> bool:
    return _exists(spark, f"{checkpoint}/metadata")


def is_file_format(fmt: str) -> bool:
    """Formats without a transaction log of their own."""
    return fmt.lower() in ("parquet", "orc", "csv", "json", "avro", "text", "xml")


def write_table(df: DataFrame, table: str, mode: str = "overwrite",
                fmt: str | None = None) -> None:
    """Save as a managed table; by default a full refresh.

    ``fmt`` picks a table format; the session's default otherwise. Replacing a
    Parquet table is not atomic for its readers, a transactional format is.
    """
    writer = df.write.mode(mode)
    if fmt:
        writer = writer.format(fmt)
    writer.saveAsTable(table)
