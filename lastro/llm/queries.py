"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import Scratch, new_path
from . import (decontaminate, embeddings, language, minhash, mixing, negatives, passages, phrases,
               quality, secrets, shards, tokens, toxicity)
from .common import fold, importable, short_batches
from .oracles import ORACLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(
        table(spark, sf_dir, "documents"), minhash.Settings(width=2))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    model = quality.fit_model(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "unit", "start", "end", "words",
                        F.lower(F.hex("digest")).alias("digest"),
                        F.col("first_id").alias("first_doc_id"), "first_unit", "kind")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 3) == 1, F.lit(False))
    model = toxicity.fit_model(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_passages(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"),
        F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.count_tokens(
        table(spark, sf_dir, "documents").select("doc_id", "text"), path,
        limit=1024).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit_models(docs), result="spans")
    place = lambda s: F.concat_ws(":", s.kind, s.start, s.end)
    base = F.filter("spans", lambda s: s.kind != "random")
    count = lambda kind: F.size(
        F.filter("spans", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"),
        count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, place), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", place), ",").alias("spans"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = language.fit_model(docs, ~held_out)
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark) as scratch:
        mixed = mixing.mix(
            table(spark, sf_dir, "documents").select("doc_id", "source", "text"),
            scratch)
        scratch.keep("mix")
    return (mixed.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
            .select(F.col("id").alias("doc_id"), "size",
                    F.col("group_size").alias("source_size"), "target",
                    (F.col("copies") * F.col("size")).alias("taken")))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark) as scratch:
        folder = scratch.paths["store"] = new_path(spark, "token-ids")
        store = shards.TokenStore.write(
            table(spark, sf_dir, "documents").select("doc_id", "text"), folder,
            public_tokenizers.path("byte_bpe_50k.json"))
        result = scratch.stage(
            store.documents().withColumnRenamed("key", "doc_id"), "documents")
        scratch.keep("documents")
    return result


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(
        F.col("label"))
    return negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this package
    return corpus_pipeline.run(spark, sf_dir)


def ready(query: Callable) -> Callable:
    """The query, in a session made ready for its Python workers first."""
    @wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        importable(spark)
        short_batches(spark)
        return query(spark, *args)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: ready(query) for name, query in {
        "op1_quality": op1_quality,
        "op2_passages": op2_passages,
        "op3_minhash": op3_minhash,
        "op4_toxicity": op4_toxicity,
        "op5_decontamination": op5_decontamination,
        "op6_tokens": op6_tokens,
        "op7_secrets": op7_secrets,
        "op8_language": op8_language,
        "op9_embeddings": op9_embeddings,
        "op10_mixing": op10_mixing,
        "op11_phrases": op11_phrases,
        "op12_token_ids": op12_token_ids,
        "op13_negatives": op13_negatives,
        "pipeline": pipeline,
    }.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
