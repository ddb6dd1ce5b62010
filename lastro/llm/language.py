"""The language of a text by error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free
from .features import gram_shares

UNDETERMINED = "und"
#: Bytes of an n-gram, and bits of its hash.
GRAM, BITS = 3, 12
#: Documents that the classifiers are fitted on, over all languages.
SAMPLE_DOCUMENTS = 3000
#: Probability of the best language below which a text is ambiguous.
CLEAR = 0.75


def codewords(languages: int, seed: int = 3) -> np.ndarray:
    """A row of bits (1 or -1) for each language.

    Up to seven languages get all ways to part them in two. More get random
    columns, 12 for each doubling of their number; of 200 such matrices the
    one whose closest rows differ most. Equal and constant columns are left out.
    """
    if languages <= 7:
        columns = [[1, *(1 if k >> b & 1 else -1 for b in range(languages - 1))]
                   for k in range(2 ** (languages - 1) - 1)]
        return np.array(columns, np.float32).reshape(-1, languages).T
    random = np.random.default_rng(seed)
    width = 12 * int(np.ceil(np.log2(languages)))
    best, most = None, -1
    for _ in range(200):
        code = random.choice(np.array([-1, 1], np.float32), (languages, width))
        code = code[:, np.abs(code.sum(axis=0)) < languages]
        apart = (code @ code.T - 2 * code.shape[1] * np.eye(languages)).max()
        if best is None or code.shape[1] - apart > most:
            best, most = code, code.shape[1] - apart
    return best


@dataclass(frozen=True)
class LanguageModel:
    """Binary classifiers, one for each bit of the codewords.

    ``trust[l, b]`` is how often classifier b was right about training texts
    of language l; a row sums to 1.
    """

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    trust: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, labels: list[str], rounds: int = 150,
            decay: float = 1e-4) -> LanguageModel:
        """Logistic regressions by full-batch gradient steps with momentum
        and scaling; languages weigh the same whatever their texts' number."""
        languages = sorted(set(labels))
        place = {name: k for k, name in enumerate(languages)}
        y = np.array([place[name] for name in labels], int)
        code = codewords(len(languages)) if languages else np.zeros((0, 0), np.float32)
        bits = code.shape[1]
        w, c = np.zeros((x.shape[1], bits), np.float32), np.zeros(bits, np.float32)
        if bits:
            goal = code[y]
            share = (1 / np.bincount(y)[y]).astype(np.float32)[:, None]
            share /= share.sum()
            m, v = [np.zeros_like(w), np.zeros_like(c)], [np.zeros_like(w), np.zeros_like(c)]
            for turn in range(1, rounds + 1):
                slope = -goal * share / (1 + np.exp(np.clip(goal * (x @ w + c), -30, 30)))
                steps = [x.T @ slope + decay * w, slope.sum(axis=0)]
                for k, (p, g) in enumerate(zip((w, c), steps)):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    p -= (0.3 * (m[k] / (1 - 0.9**turn))
                          / (np.sqrt(v[k] / (1 - 0.99**turn)) + 1e-6))
            right = (np.sign(x @ w + c) == goal).astype(np.float32)
            trust = np.array([right[y == k].mean(axis=0) for k in range(len(languages))])
            trust /= np.maximum(trust.sum(axis=1, keepdims=True), 1e-9)
        else:
            trust = np.ones((len(languages), 0), np.float32)
        return cls(languages, code, w, c, trust)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, probability) numbers of rows: the codeword with the least
        loss, each bit's loss weighted by the trust put in its classifier."""
        if len(self.languages) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        margins = x @ self.weights + self.offsets
        loss = np.empty((len(x), len(self.languages)))
        for k, word in enumerate(self.code):
            loss[:, k] = (np.logaddexp(0, -word * margins) * self.trust[k]).sum(axis=1)
        best = loss.argmin(axis=1)
        odds = np.exp(loss.min(axis=1, keepdims=True) - loss)
        return best, 1 / odds.sum(axis=1)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text; ``und`` and 0 without a letter."""
        out = [(UNDETERMINED, 0.0)] * len(texts)
        known = [k for k, t in enumerate(texts)
                 if self.languages and t and any(map(str.isalpha, t))]
        for start in range(0, len(known), 256):
            part = known[start:start + 256]
            x = np.array([gram_shares(texts[k], GRAM, BITS) for k in part])
            for k, best, p in zip(part, *self.decode(x)):
                out[k] = self.languages[best], float(p)
        return out


def fit_model(docs: DataFrame, train: Column, text_col: str = "text",
              lang_col: str = "lang", id_col: str = "doc_id",
              documents: int = SAMPLE_DOCUMENTS) -> LanguageModel:
    """A model from a bounded sample of the rows for which ``train`` holds.

    Of each language the same number of documents is taken, those with the
    smallest hashes of their ids, ``documents`` in all. Rows without language
    or id are not used, nor are texts without letters.
    """
    spark = docs.sparkSession
    some = docs.select(id_col, text_col, lang_col).where(train & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
                      & F.col(text_col).isNotNull())
    # a partial limit in each task comes before the shuffle by language
    languages = some.agg(F.count_distinct(lang_col)).first()[0] or 1
    each = max(20, documents // languages)
    order = Window.partitionBy(lang_col).orderBy(
        F.xxhash64(F.col(id_col), F.lit(5)), id_col)
    ids = (some.select(id_col, lang_col).withColumn("_n", F.row_number().over(order))
           .where(F.col("_n") <= each).select(F.col(id_col).alias("_id"),
                                              F.col(lang_col).alias("_lang")))
    ids = spark.createDataFrame(ids.collect(), ids.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(lang, gram_shares(text, GRAM, BITS)) for lang, text in
                    zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            rows = [(lang, x.tobytes()) for lang, x in rows if x.any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.binary())], ["lang", "x"])
    chosen = some.join(F.broadcast(ids), (F.col(id_col) == F.col("_id"))
                       & (F.col(lang_col) == F.col("_lang")))
    rows = (chosen.select("_lang", F.col(text_col)).mapInArrow(
        run, "lang string, x binary").orderBy("lang", "x").collect())
    x = np.array([np.frombuffer(r[1], np.float32) for r in rows], np.float32)
    return LanguageModel.fit(x.reshape(len(rows), 1 << BITS), [r[0] for r in rows])


PREDICTED = "lang_pred string, score double, ambiguous boolean"


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             clear: float = CLEAR) -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous.

    ``score`` is the probability of the language among those known;
    ``ambiguous`` marks scores below ``clear``. NULL texts and texts without a
    letter are ``und`` with score 0, and ambiguous; so is every text where the
    model knows no language. Columns of these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        found = shared.value.predict(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64()),
             pa.array([f[1] < clear for f in found], pa.bool_())],
            ["lang_pred", "score", "ambiguous"])
    names = ["lang_pred", "score", "ambiguous"]
    own = free(docs, "_found")
    found = docs.withColumn(own, F.arrow_udf(run, PREDICTED)(F.col(text_col)))
    return found.withColumns({c: F.col(f"{own}.{c}") for c in names}).drop(own)
