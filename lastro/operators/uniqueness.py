"""Rows that share a key that should be unique."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lastro.names import DUPLICATE_COUNT, quoted, same_name
from lastro.sources.scratch import stage

# A key is hot when it holds more than 1/HOT_KEYS of the duplicate rows, so
# there are never more than HOT_KEYS hot keys, however large the table.
HOT_KEYS = 100_000
# What a broadcast list of keys may take in memory. More hot keys than fit are
# cut to the more frequent ones.
BROADCAST_BYTES = 64 * 1024 * 1024
# Parts into which the rows of a hot key are dealt where rows are shuffled.
SALTS = 1000


def repeated_keys(df: DataFrame, *keys: str,
                  count_col: str = DUPLICATE_COUNT) -> DataFrame:
    """Each key that occurs more than once, and how often; NULL is a key.

    Only the key columns are read and shuffled, already counted per task.
    """
    return (df.groupBy(*[F.col(quoted(k)) for k in keys])
            .agg(F.count("*").alias(count_col))
            .filter(F.col(quoted(count_col)) > 1))


def duplicates(df: DataFrame, *keys: str, count_col: str = DUPLICATE_COUNT,
               hot_keys: int = HOT_KEYS,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row whose key occurs more than once, with the size of its group.

    A window over the key would shuffle and sort whole rows, and put all rows
    of a frequent key into one task. Here the repeated keys are counted first
    and written out. Their size in memory is measured, and then

    * if all of them fit into ``broadcast_bytes``, rows are matched where they
      are read and nothing but keys is ever shuffled;
    * otherwise those with more than 1/``hot_keys`` of the duplicate rows are
      broadcast, the frequency being raised until they fit. That list marks
      the rows of frequent keys as they are read; in the shuffle that matches
      the others, marked rows are dealt by a salt, so no task gets one key's.

    The broadcasts are hinted, because their size is known: no setting of the
    session turns them into shuffles of a frequent key. Counting runs when
    this is called. ``df`` is read again, once, for the rows, so it must give
    the same rows each time.
    """
    if not keys:
        raise ValueError("duplicates needs at least one key column")
    renamed = [f"__key_{i}" for i in range(len(keys))]
    counts = stage(
        repeated_keys(df, *keys, count_col=count_col)
        .toDF(*renamed, "__count"), "repeated-keys")
    width = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) + 24
                 for k in renamed), F.lit(24))
    size = F.sum(width)
    total = counts.agg(F.sum("__count").alias("rows"), size.alias("bytes")).first()
    if (total["bytes"] or 0) <= broadcast_bytes:
        found = df.join(F.broadcast(counts), _same_key(df, counts, keys, renamed))
        return _with_count(df, found, F.col("__count"), count_col)

    cut = total["rows"] // hot_keys
    while True:
        hot = counts.filter(F.col("__count") > cut)
        if (hot.agg(size).first()[0] or 0) <= broadcast_bytes:
            break
        cut = max(2 * cut, 2)
    hot = hot.toDF(*[f"__hot{k}" for k in renamed], "__hot_count")
    marked = df.join(F.broadcast(hot), _same_key(
        df, hot, keys, hot.columns[:-1]), "left")
    # a salted row matches nothing in the list of rare keys, whatever its salt
    salt = F.when(F.col("__hot_count").isNull(), 0).otherwise(
        1 + F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    marked = marked.withColumn("__salt", salt.cast("int"))
    # 0, but not a literal: that would be folded into a filter on the salt, and
    # rows would be dealt by their key alone
    rare = counts.filter(F.col("__count") <= cut).withColumn(
        "__rare", F.least(F.col("__count"), F.lit(0)).cast("int"))
    matched = marked.join(rare, _same_key(df, rare, keys, renamed)
                          & (marked["__salt"] == rare["__rare"]), "left")
    count = F.coalesce("__hot_count", "__count")
    return _with_count(df, matched.filter(count.isNotNull()), count, count_col)


def _same_key(df: DataFrame, counts: DataFrame, keys: tuple[str, ...],
              renamed: list[str]) -> Column:
    pairs = [df[quoted(k)].eqNullSafe(counts[r]) for k, r in zip(keys, renamed)]
    return reduce(Column.__and__, pairs)


def _with_count(df: DataFrame, found: DataFrame, count: Column,
                count_col: str) -> DataFrame:
    """The columns of ``df``, one named like the count replaced by it."""
    kept = [df[quoted(c)] for c in df.columns
            if not same_name(df.sparkSession, c, count_col)]
    return found.select(*kept, count.alias(count_col))
