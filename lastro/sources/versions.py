"""Several tables replaced at one moment, in formats without transactions.

Each table is a view of the newest committed version. A version's files are
written beside the old ones, and one small file added to the log of commits
switches all tables at once: every view asks the log which version is its own.

A view is whole at any moment. A query over several views asks the log once for
each, so one that starts just while a commit happens may take some from before
it; ``snapshot`` asks once for all.
"""

from __future__ import annotations

import hashlib
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.names import quoted
from lastro.sources.scratch import remove
from lastro.sources.tables import is_file_format, table_facts

VERSION = "_versao"
LOG_SCHEMA = f"{VERSION} BIGINT, visao STRING, pasta STRING, em TIMESTAMP"


def schema_location(spark: SparkSession, schema: str) -> str:
    """The folder in which a schema keeps its tables."""
    for name, value in spark.sql(f"DESCRIBE SCHEMA {schema}").collect():
        if name.lower() == "location":
            return value.rstrip("/")
    raise ValueError(f"{schema} has no location")


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in ``path``; none if there is no such path."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    return [str(f.getPath()) for f in store.listStatus(folder) if f.isDirectory()]


def read_log(spark: SparkSession, home: str) -> DataFrame:
    """(_versao, visao, pasta, em) of every commit below ``home``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/confirmadas")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(LOG_SCHEMA).parquet(f"{home}/confirmadas")
    return spark.createDataFrame([], LOG_SCHEMA)


def snapshot(spark: SparkSession, home: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """By name, all released tables as the newest commit left them."""
    newest = read_log(spark, home.rstrip("/")).groupBy("visao").agg(
        F.max(F.struct(VERSION, "pasta")).alias("own")).collect()
    return {r["visao"]: spark.read.format(fmt).load(
        f"{r['own']['pasta']}/{VERSION}={r['own'][VERSION]}") for r in newest}


class Release:
    """Tables of one new version below ``home``, seen by nobody until ``commit``.

    ``home`` belongs to the views that are released in it, and to one writer at
    a time. A release that is not committed changes nothing; its files go with
    the next ``clean``.
    """

    def __init__(self, spark: SparkSession, home: str, fmt: str = "parquet"):
        if not is_file_format(fmt):
            raise ValueError(f"{fmt} replaces tables by itself")
        self.spark, self.home, self.fmt = spark, home.rstrip("/"), fmt
        last = read_log(spark, self.home).agg(F.max(VERSION)).first()[0] or 0
        self.version = max(time.time_ns() // 1000, last + 1)
        self.written: dict[str, tuple[str, list[str]]] = {}

    def write(self, df: DataFrame, view: str) -> DataFrame:
        """``df`` as the next version of ``view``; returns it as read back.

        Versions of one schema share a folder, of which the version is a
        partition, so a reader lists and reads its own version only.
        """
        if table_facts(self.spark, view).get("provider"):
            raise ValueError(f"{view} is a table; drop it once, for a view to take its name")
        shape = hashlib.md5(f"{self.fmt} {df.schema.json()}".encode()).hexdigest()[:8]
        name = re.sub(r"\W+", "_", view).strip("_")
        folder = f"{self.home}/{name}/{shape}"
        path = f"{folder}/{VERSION}={self.version}"
        df.write.format(self.fmt).mode("overwrite").save(path)
        self.written[view] = folder, df.columns
        return self.spark.read.format(self.fmt).schema(df.schema).load(path)

    def commit(self) -> None:
        """Switch all written tables to this version, by adding one file.

        A view that is new, or whose columns or types are not those of its last
        version, is then created; until then the old one shows the old version.
        """
        log = read_log(self.spark, self.home)
        newest = {r["visao"]: r["pasta"] for r in log.groupBy("visao").agg(
            F.max_by("pasta", VERSION).alias("pasta")).collect()}
        rows = [(self.version, view, folder) for view, (folder, _) in self.written.items()]
        (self.spark.createDataFrame(rows, LOG_SCHEMA.rsplit(",", 1)[0]).coalesce(1)
         .withColumn("em", F.current_timestamp())
         .write.mode("append").parquet(f"{self.home}/confirmadas"))
        for view, (folder, columns) in self.written.items():
            if newest.get(view) != folder or not self.spark.catalog.tableExists(view):
                self._create_view(view, folder, columns)

    def _create_view(self, view: str, folder: str, columns: list[str]) -> None:
        literal = "'{}'".format(view.replace("\\", "\\\\").replace("'", "\\'"))
        own = "'{}'".format(folder.replace("\\", "\\\\").replace("'", "\\'"))
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {view} AS "
            f"SELECT {', '.join(map(quoted, columns))} FROM {self.fmt}.{quoted(folder)} "
            f"WHERE {VERSION} = (SELECT max({VERSION}) "
            f"FROM parquet.{quoted(self.home + '/confirmadas')} "
            f"WHERE visao = {literal} AND pasta = {own})")

    def clean(self, keep: int = 2) -> list[int]:
        """Remove all but the ``keep`` newest committed versions, and what was
        never committed before the newest; returns the removed versions.

        A query that still reads a version when it is removed fails, so
        ``keep`` covers as many refreshes as the longest query takes.
        """
        log = read_log(self.spark, self.home)
        committed = [r[0] for r in log.select(VERSION).distinct().orderBy(
            F.col(VERSION).desc()).limit(max(1, keep)).collect()]
        removed = set()
        for table in folders(self.spark, self.home):
            for shape in folders(self.spark, table):
                for path in folders(self.spark, shape):
                    found = re.fullmatch(rf".*/{VERSION}=(\d+)", path)
                    if (found and committed and int(found[1]) < committed[0]
                            and int(found[1]) not in committed):
                        remove(self.spark, path)
                        removed.add(int(found[1]))
        return sorted(removed)
