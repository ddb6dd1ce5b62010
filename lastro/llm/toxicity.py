"""Toxic documents by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample
from .features import present

#: Bytes of an n-gram, bits of its hash, and n-grams that a model may use.
GRAM, BITS, USED = 5, 20, 2048
#: Rows that the classifier is fitted on.
SAMPLE_TOXIC, SAMPLE_UNLABELLED = 3000, 6000


@dataclass(frozen=True)
class ToxicityModel:
    """A linear classifier over which of the chosen n-grams a text has."""

    weights: np.ndarray
    offset: float

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability that each text is toxic; NULL counts as empty."""
        used = self.weights != 0
        out = []
        for text in texts:
            found = present(text or "", GRAM, BITS, used)
            z = self.offset + float(self.weights[found].sum())
            out.append(1 / (1 + np.exp(-np.clip(z, -40, 40))))
        return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_weights(toxic: np.ndarray, unlabelled: np.ndarray, prior: float,
                rounds: int = 400, rate: float = 0.1, sparsity: float = 0.04,
                ) -> tuple[np.ndarray, float]:
    """(weights, offset) that minimise the non-negative risk.

    The risk of calling toxic texts clean comes from the toxic examples,
    weighted by the class prior. That of calling clean ones toxic is taken
    over the unlabelled texts, less the share that the toxic ones among them
    contribute; as an average over samples it may fall below zero, which only
    overfitting can bring about. Then the step goes back along its gradient
    in place of following it. Steps become shorter, weights shrink with each
    by ``sparsity`` of it, and the mean of the later half of them is returned.
    """
    p, u = toxic.astype(np.float32), unlabelled.astype(np.float32)
    w, c = np.zeros(p.shape[1], np.float32), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sum_w, sum_c, summed = np.zeros(len(w)), 0.0, 0
    for turn in range(1, rounds + 1):
        zp, zu = p @ w + c, u @ w + c
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        # slopes of the losses by z
        over = _sigmoid(zu) / len(zu)
        less = -prior * _sigmoid(zp) / len(zp)
        missed = -prior * _sigmoid(-zp) / len(zp)
        by_p, by_u = (missed + less, over) if negative >= 0 else (-less, -over)
        slope = np.append(by_p.astype(np.float32) @ p + by_u.astype(np.float32) @ u,
                          by_p.sum() + by_u.sum())
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        length = rate / (1 + 4 * turn / rounds)
        step = length * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-4)
        w = (w - step[:-1]).astype(np.float32)
        c -= float(step[-1])
        w = np.sign(w) * np.maximum(np.abs(w) - sparsity * length, 0)
        if 2 * turn > rounds:
            sum_w, sum_c, summed = sum_w + w, sum_c + c, summed + 1
    return sum_w / max(1, summed), sum_c / summed if summed else c


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either kind that have each n-gram, added up in the task."""
    totals = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            totals[int(toxic), present(text or "", GRAM, BITS)] += 1
    seen = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int32()), pa.array(totals[1, seen], pa.int64()),
         pa.array(totals[0, seen], pa.int64())], ["gram", "toxic", "other"])


def _chosen_grams(used: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[used] = True
        for batch in batches:
            found = [np.searchsorted(used, present(t or "", GRAM, BITS, wanted))
                     for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f.astype(np.int16).tobytes() for f in found],
                                           pa.binary())], ["toxic", "grams"])
    return run


def training_rows(docs: DataFrame, labels: DataFrame, train: Column,
                  id_col: str = "doc_id", label_col: str = "toxic",
                  text_col: str = "text", toxic_rows: int = SAMPLE_TOXIC,
                  unlabelled_rows: int = SAMPLE_UNLABELLED, seed: int = 13,
                  ) -> tuple[DataFrame, float]:
    """((toxic, text) rows, class prior) of a bounded training set.

    ``train`` selects, by ``id_col``, the rows that may be learned from:
    confirmed toxic ones by their label, unlabelled ones by nothing but their
    id. The prior is the share of label 1 among all selected labels.
    """
    spark = docs.sparkSession
    known = labels.where(train & F.col(label_col).isNotNull())
    prior = known.agg(F.avg(F.col(label_col).cast("double"))).first()[0] or 0.0
    chosen = []
    for flag, source, rows in ((1, known.where(F.col(label_col) == 1), toxic_rows),
                               (0, docs.where(train), unlabelled_rows)):
        ids = bounded_sample(source.select(id_col).distinct() if flag else
                             source.select(id_col), id_col, rows, seed)
        chosen.append(ids.select(F.col(id_col).alias("_id"), F.lit(flag).alias("_toxic")))
    ids = chosen[0].union(chosen[1])
    ids = spark.createDataFrame(ids.collect(), ids.schema)  # bounded by the sample
    rows = docs.select(id_col, text_col).join(F.broadcast(ids), F.col(id_col) == F.col("_id"))
    return rows.select(F.col("_toxic").alias("toxic"), F.col(text_col).alias("text")), prior


def fit_model(docs: DataFrame, labels: DataFrame, train: Column,
              prior: float | None = None, **options) -> ToxicityModel:
    """A model from confirmed toxic and unlabelled documents.

    The n-grams that most clearly more of the toxic documents have are chosen
    first: counts are added up in tasks, then over them.
    Without a toxic example every text gets the prior, at most a half.
    """
    rows, found = training_rows(docs, labels, train, **options)
    prior = min(0.5, max(1e-4, found if prior is None else prior))
    counts = (rows.mapInArrow(_counts, "gram int, toxic long, other long")
              .groupBy("gram").agg(F.sum("toxic").alias("toxic"),
                                   F.sum("other").alias("other")))
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    empty = np.zeros(1 << BITS)
    if not sizes.get(1) or not sizes.get(0):
        return ToxicityModel(empty, float(np.log(prior / (1 - prior))))
    p, u = F.col("toxic") / sizes[1], F.col("other") / sizes[0]
    spread = F.sqrt((F.col("toxic") + 1) / sizes[1] ** 2
                    + (F.col("other") + 1) / sizes[0] ** 2)
    best = (counts.where("toxic + other >= 4")
            .where(p > u).orderBy(F.desc((p - u) / spread), "gram").limit(USED))
    used = np.sort(np.array([r[0] for r in best.select("gram").collect()], np.int64))
    matrix = {0: np.zeros((sizes[0], len(used)), np.uint8),
              1: np.zeros((sizes[1], len(used)), np.uint8)}
    at = {0: 0, 1: 0}
    for flag, grams in (rows.mapInArrow(_chosen_grams(used), "toxic int, grams binary")
                        .orderBy("toxic", "grams").collect()):
        matrix[flag][at[flag], np.frombuffer(grams, np.int16)] = 1
        at[flag] += 1
    w, c = fit_weights(matrix[1], matrix[0], prior)
    weights = empty
    weights[used] = w
    return ToxicityModel(weights, c)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """``docs`` with score and predicted, 1 from ``threshold`` on.

    NULL and empty texts get the score of a text without any n-gram. Whole
    texts are read. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.scores(texts.to_pylist()), pa.float64())
    scored = docs.withColumn("score", F.arrow_udf(run, "double")(F.col(text_col)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
