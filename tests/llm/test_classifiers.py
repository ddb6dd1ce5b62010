"""Quality rules, toxicity and language: accuracy, edge cases, inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastro.llm import language, quality, queries, toxicity
from lastro.llm.common import fold
from tests.llm.helpers import LONG, awkward, docs, empty, words

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def held_out_accuracy(spark, found, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = (found.where("held_out").join(labels, "doc_id")
            .select("predicted", F.col(label).alias("label")).collect())
    right = sum(r.predicted == r.label for r in rows) / len(rows)
    hits = [r.predicted for r in rows if r.label == 1]
    return right, sum(hits) / len(hits)


def contract(spark, found, parts, remainder):
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    import zlib
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == remainder)
        assert 0 <= r.score <= 1


def test_quality_on_held_out_rows(spark):
    found = queries.op1_quality(spark, SF).cache()
    contract(spark, found, 3, 1)
    assert all(r.predicted == (r.score >= 0.5) for r in found.collect())
    right, caught = held_out_accuracy(spark, found, "quality")
    assert right >= 0.97 and caught >= 0.97


def test_toxicity_on_held_out_rows(spark):
    found = queries.op4_toxicity(spark, SF).cache()
    contract(spark, found, 3, 1)
    assert all(r.predicted == (r.score >= 0.7) for r in found.collect())
    right, caught = held_out_accuracy(spark, found, "toxic")
    assert right >= 0.92 and caught >= 0.6


def test_language_on_held_out_rows(spark):
    found = queries.op8_language(spark, SF).cache()
    contract(spark, found, 5, 0)
    docs_ = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs_, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) >= 0.97


def test_held_out_labels_change_nothing(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    train = fold("doc_id", 3) != 1
    turned = labels.withColumn("quality", F.when(train, F.col("quality"))
                               .otherwise(1 - F.col("quality")))
    a, b = (quality.fit_model(table, x, train) for x in (labels, turned))
    assert a == b
    some = table.withColumn("lang", F.when(fold("doc_id", 5) != 0, F.col("lang"))
                            .otherwise("xx"))
    model = language.fit_model(some, fold("doc_id", 5) != 0)
    assert "xx" not in model.languages


def test_rules_as_columns_score_as_in_numpy(spark):
    random = np.random.default_rng(1)
    x = random.random((400, len(quality.STATISTICS)))
    y = ((x[:, 2] < 0.5) & (x[:, 3] < 0.7)).astype(int)
    model = quality.RuleEnsemble.fit(list(quality.STATISTICS), x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95
    assert model.rules and "if" in str(model)
    df = spark.createDataFrame([tuple(map(float, row)) for row in x],
                               [f"__lastro_q_{n}" for n in quality.STATISTICS])
    found = [r[0] for r in df.select(model.column()).collect()]
    assert np.allclose(found, model.score(x))


def test_lasso_leaves_useless_rules_out():
    random = np.random.default_rng(2)
    z = (random.random((800, 30)) < 0.4).astype(float)
    y = z[:, 4]
    w, _ = quality.lasso_logistic(z, y, np.ones(800), penalty=0.02)
    assert abs(w[4]) > 10 * np.abs(np.delete(w, 4)).max()


def test_a_filter_on_a_score_is_not_made_of_the_texts_again(spark):
    table = docs(spark, [(k, words(30, k)) for k in range(20)])
    random = np.random.default_rng(3)
    x = random.random((200, len(quality.STATISTICS)))
    model = quality.RuleEnsemble.fit(list(quality.STATISTICS), x, (x[:, 0] > 0.5) * 1)
    plan = (quality.score(table, model).where("predicted = 1 AND score > 0.1")
            ._jdf.queryExecution().optimizedPlan().toString())
    assert plan.count(quality.COUNTED["same_as_next"]) <= 2


def test_non_negative_risk_finds_the_marked_words():
    random = np.random.default_rng(4)
    def rows(n, share):
        noise = random.random((n, 60)) < 0.03
        noise[:, :5] |= (random.random((n, 5)) < 0.6) & (random.random(n) < share)[:, None]
        return noise.astype(np.uint8)
    w, c = toxicity.fit_weights(rows(300, 1.0), rows(2000, 0.1), prior=0.1)
    z = rows(500, 0.0) @ w + c
    assert (1 / (1 + np.exp(-z)) >= 0.7).mean() < 0.05
    assert (1 / (1 + np.exp(-(rows(500, 1.0) @ w + c))) >= 0.7).mean() > 0.8


@pytest.mark.parametrize("count", [2, 4, 7, 9, 30])
def test_codewords_part_all_languages(count):
    code = language.codewords(count)
    assert code.shape[0] == count
    assert (np.abs(code.sum(axis=0)) < count).all()
    apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
    assert min(apart) >= 1 and (count < 4 or min(apart) >= 3)


def test_errors_of_a_classifier_are_corrected():
    code = language.codewords(4)
    model = language.LanguageModel(
        ["a", "b", "c", "d"], code, np.eye(7, dtype=np.float32), np.zeros(7),
        np.full((4, 7), 1 / 7))
    for k, word in enumerate(code):
        for wrong in range(7):
            margins = 3 * word.copy()
            margins[wrong] *= -1
            assert model.decode(margins[None, :])[0][0] == k


def test_language_without_letters_and_without_languages(spark):
    table = awkward(spark, "lang_pred score ambiguous")
    model = language.fit_model(table, F.lit(True))
    assert model.languages == ["en", "fr"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(
        table, model).where("doc_id IS NOT NULL").collect()}
    assert found[3] == found[4] == found[5] == ("und", 0.0)
    assert found[8][0] == "fr" and found[6][0] == "en"
    none = language.fit_model(empty(spark), F.lit(True))
    rows = language.identify(table, none).collect()
    assert len(rows) == 11 and {r.lang_pred for r in rows} == {"und"}
    one = language.fit_model(table.where("lang = 'en'"), F.lit(True))
    assert language.identify(table.where("doc_id = 1"), one).first().score == 1.0


def test_classifiers_take_awkward_rows_and_no_labels(spark):
    table = awkward(spark, "score predicted _row toxic")
    some = spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 0, 1), (6, 1, None), (None, 1, 1), (7, None, 0)], LABELS)
    for labels in (some, spark.createDataFrame([], LABELS)):
        model = quality.fit_model(table, labels, F.lit(True))
        rows = quality.score(table, model).collect()
        assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
        assert quality.score(empty(spark), model).collect() == []
        toxic = toxicity.fit_model(table, labels, F.lit(True))
        rows = toxicity.score(table, toxic).collect()
        assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
        assert toxicity.score(empty(spark), toxic).collect() == []
    assert quality.fit_model(empty(spark), some, F.lit(True)).rules == []


def test_whole_texts_are_read(spark):
    """What counts stands at the very end of a long text."""
    weights = np.zeros(1 << toxicity.BITS)
    from lastro.llm.features import present
    weights[present("idiotic", toxicity.GRAM, toxicity.BITS)] = 5.0
    model = toxicity.ToxicityModel(weights, -4.0)
    low, high = model.scores([LONG, LONG + " idiotic"])
    assert low < 0.1 and high > 0.9
