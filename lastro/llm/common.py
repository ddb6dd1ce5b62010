"""What several operators share: folds, bounded samples, joins on hot keys."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A list of this many short rows may be broadcast; longer ones are shuffled.
BROADCAST_ROWS = 1_000_000


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder it lies in.

    That holds for workers on this machine, and on others with the same
    folder. A cluster without it gets the package by ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    paths = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([*paths, root])


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most ``rows``.

    Spark's 10,000 rows of long texts would be a gigabyte in a worker and in
    its executor. A session that asks for fewer, or was told another number
    than the default, keeps its own.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def fold(key: str, parts: int) -> Column:
    """Which of ``parts`` folds a row is in: crc32 of its id as text."""
    return F.crc32(F.col(key).cast("string")) % parts


def raw(column: str) -> Column:
    """A text as its UTF-8 bytes; NULL as none."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def free(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of their key.

    The choice depends on keys alone, so reruns and other partitionings give
    the same rows. Only a classifier's training set is ever taken this way.
    """
    order = F.xxhash64(F.col(key), F.lit(seed))
    return df.where(F.col(key).isNotNull()).orderBy(order, F.col(key)).limit(rows)


def with_small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` hinted for broadcast when its counted rows are few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def spread_join(left: DataFrame, right: DataFrame, key: str,
                how: str = "inner", rows_per_task: int = 200_000) -> DataFrame:
    """Join on ``key``, with the rows of frequent keys dealt over many tasks.

    ``left`` is a staged table, as it is read twice; ``right`` has one row for
    a key, or a few. Keys that hold over a thousandth of ``left`` (so never
    more than a thousand of them) get salts; their right row is repeated once
    for each salt.
    """
    spark = left.sparkSession
    total = left.count()
    frequent = max(rows_per_task, total // 1000)
    if total <= frequent:
        return left.join(right, key, how)
    hot = (left.groupBy(key).count().where(F.col("count") > frequent)
           .select(key, F.ceil(F.col("count") / frequent).cast("int").alias("_salts")))
    hot = spark.createDataFrame(hot.collect(), hot.schema)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    dealt = (left.join(F.broadcast(hot), key, "left")
             .withColumn("_salt", F.pmod(F.xxhash64(*left.columns), salts).cast("int"))
             .drop("_salts"))
    repeated = (right.join(F.broadcast(hot), key, "left")
                .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
                .drop("_salts"))
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")
