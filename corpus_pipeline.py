"""A corpus from raw documents: five stages, each written before the next.

Rows without an id, NULL and empty texts, repeated rows and further columns
pass every stage by the rules of its operator; an empty table stays empty.
Columns that a stage adds for itself never remain, except the last one's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lastro.llm import decontaminate, minhash, mixing, quality, secrets
from lastro.llm.common import fold
from lastro.llm.queries import ready
from lastro.sources.scratch import collected, new_path, remove, stage

#: SQL cannot express the fitted stages; tests hold each against brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts. It learns from the labels of
    two folds of three; a document without text is judged as an empty one."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = F.coalesce(fold("doc_id", 3) != 1, F.lit(False))
    model = quality.fit_model(docs.select("doc_id", "text"), labels, train)
    own = [f"_own_{c}" for c in docs.columns]  # no column is taken for a score
    return (quality.score(docs.toDF(*own), model, "_own_text")
            .where("predicted = 1").select(*own).toDF(*docs.columns))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id.
    Five words a shingle, similarity from 0.8; documents without words stay."""
    return minhash.deduplicate(docs, minhash.Settings(width=5, percent=80))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str,
                              ) -> DataFrame:
    """Documents without any ten consecutive words of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark, window=10)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark; n_chars follows."""
    models = secrets.fit_models(docs.select("doc_id", "text"))
    masked = secrets.redact(docs, models)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn(
        "n_chars", F.when(F.col("n_chars").isNotNull(),
                          F.length("text").cast(kind))).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the mix of sources takes them, numbered by copy."""
    return mixing.apply_mix(docs)


STAGES = [
    ("quality classifier", ready(quality_classifier)),
    ("minhash near-dedup", ready(minhash_near_dedup)),
    ("benchmark decontamination", ready(benchmark_decontamination)),
    ("secret scans", ready(secret_scans)),
    ("mixing sources", ready(source_mixing)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each staged in the shared folder.

    Only the last stage's result stays there: a stage goes when the next one is
    written, and with it whatever its operator left for it.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES:
        with collected() as made:
            path = new_path(spark, name.replace(" ", "-"))
            docs = stage(function(spark, docs, sf_dir), name, path)
        for other in [*before, *(p for p in made if p != path)]:
            remove(spark, other)
        before = [path]
    return docs
