"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog and runs away " * 3000


def docs(spark: SparkSession, rows: list[tuple], more: str = "") -> DataFrame:
    """(doc_id, text) rows as documents; ``more`` names further columns, of
    which each holds the text 'x'."""
    full = [(k, t, "en", f"s{(k or 0) % 3}", len(t) if t is not None else None)
            for k, t in rows]
    df = spark.createDataFrame(full, DOCS)
    for name in more.split():
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def awkward(spark: SparkSession, more: str = "") -> DataFrame:
    """NULLs in any column, empty, blank and very long texts, repeated rows."""
    text = "a plain sentence of some eight or nine words here"
    rows = [(1, text, "en", "s1", 50), (2, text, None, None, None),
            (2, text, None, None, None), (3, None, "en", "s1", None),
            (4, "", "en", "s1", 0), (5, " \n\t ", "en", "s1", 4),
            (None, text, "en", "s1", 50), (None, None, None, None, None),
            (6, LONG, "en", "s2", len(LONG)), (7, "word", "en", "s2", 4),
            (8, "été 123 … ÄÖ", "fr", "s2", 12)]
    df = spark.createDataFrame(rows, DOCS)
    for name in more.split():
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def words(count: int, seed: int) -> str:
    """A text of ``count`` words that other seeds do not share."""
    state, out = seed * 7919 + 1, []
    for _ in range(count):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(f"w{seed}x{state % 5000}")
    return " ".join(out)
