"""Incremental ingestion: each delivered file enters the history once."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lastro.names import DELIVERY_SCHEMA
from lastro.sources.deliveries import traceable, with_origin
from lastro.sources.tables import (
    has_checkpoint,
    has_files,
    has_stream_log,
    is_file_format,
    table_facts,
)

#: Older than any file: no file is left out for its age.
ANY_AGE = "36500d"


def ingest_arrivals(spark: SparkSession, folder: str, table: str,
                    checkpoint: str, schema: str = DELIVERY_SCHEMA,
                    max_files: int | None = None, fmt: str | None = None,
                    max_age: str = ANY_AGE, **options: str) -> None:
    """Append the files that arrived in ``folder`` since the last call.

    Runs until all present files are loaded, then stops. ``checkpoint`` holds
    the record of loaded files and belongs in durable shared storage; with it,
    a call repeated after a failure neither loses nor doubles rows.
    ``max_files`` bounds one micro-batch when a backlog is large. Tables are
    made in ``fmt``, in the table's own format if it exists, or in the
    session's default.

    A file counts as loaded by its path. One that is delivered again under the
    same path, with other content, is not read again: deliveries need new names.
    A file whose header is another one stops the stream until it is gone; where
    such files come, ``lastro.sources.load_deliveries`` puts them aside, and
    loads all others.

    The driver keeps one entry, of about 200 bytes, for each file younger than
    ``max_age``, measured against the youngest loaded. By default that is every
    file ever loaded, and none is lost for its age. To bound the record, let
    loaded files leave the folder, with the options ``cleanSource="archive"``
    and ``sourceArchiveDir``, and set ``max_age`` above the age at which the
    slowest delivery may still arrive: younger files are then always known,
    and older ones are gone. A shorter ``max_age`` loses late files.

    Unless the format is transactional, the table must be written by this
    function only, with one checkpoint: Spark's file sink keeps a log of its
    files and readers ignore any that are not in it. A table with other files,
    or a log that another checkpoint wrote, is refused before anything is read.
    """
    facts = table_facts(spark, table)
    fmt = fmt or facts.get("provider") or spark.conf.get("spark.sql.sources.default")
    if facts and is_file_format(fmt):
        logged = has_stream_log(spark, facts["location"])
        if not logged and has_files(spark, facts["location"]):
            raise ValueError(f"{table} has rows that were not written by "
                             "ingest_arrivals; they would no longer be seen")
        if logged and not has_checkpoint(spark, checkpoint):
            raise ValueError(f"{table} was written with another checkpoint than "
                             f"{checkpoint}; its new files would be skipped")
    if max_files is not None:
        options["maxFilesPerTrigger"] = str(max_files)
    options = {"maxFileAge": max_age, **options}
    arrived = traceable(spark.readStream, schema, **options).csv(folder)
    query = (with_origin(arrived).writeStream
             .outputMode("append")
             .format(fmt)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .toTable(table))
    query.awaitTermination()
    spark.catalog.refreshTable(table)
