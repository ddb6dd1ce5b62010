"""Hard negatives against a brute-force version, and awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lastro.llm.negatives import Settings, hard_negatives, scores

ROWS = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
         "negative_score"]


def brute(rows, settings=Settings(), every=10):
    valid = {}
    for key, vector, label in sorted(
            (r for r in rows if None not in r
             and all(x is not None and np.isfinite(x) for x in r[1])),
            key=lambda r: (r[0], r[2], r[1])):
        whole = [int(np.floor(settings.scale * float(x))) for x in vector]
        valid.setdefault(key, (label, whole))
    out = []
    for anchor, (label, vector) in valid.items():
        if anchor % every:
            continue
        ranked = sorted((-sum(p * q for p, q in zip(vector, v)), key, own)
                        for key, (own, v) in valid.items() if len(v) == len(vector))
        positives = [(k, -s) for s, k, own in ranked if k != anchor and own == label]
        for positive, of in positives[:settings.positives]:
            found = [(k, -s) for s, k, own in ranked if own != label
                     and settings.low * of <= -100 * s <= settings.high * of]
            out += [(anchor, positive, n + 1, k, of, s)
                    for n, (k, s) in enumerate(found[:settings.negatives])]
    return sorted(out)


def mined(spark, rows, settings=Settings(), every=10, more=""):
    table = spark.createDataFrame(rows, ROWS)
    for name in more.split():
        table = table.withColumn(name, F.lit("x"))
    found = hard_negatives(table, F.col("vec_id") % every == 0, settings=settings)
    assert found.columns == NAMES
    return sorted(tuple(r) for r in found.collect())


def vectors(count, seed, width=4, values=None):
    random = np.random.default_rng(seed)
    draw = (lambda: random.choice(values, width)) if values else (
        lambda: random.normal(size=width).astype(np.float32))
    return [(k, [float(x) for x in draw()], int(random.integers(0, 3)))
            for k in range(count)]


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = vectors(300, seed)
    assert mined(spark, rows) == brute(rows) != []


def test_ties_and_scores_of_zero(spark):
    # few values, so that most scores are equal and many are zero
    rows = vectors(240, 5, width=2, values=[-0.5, 0.0, 0.5])
    found = mined(spark, rows)
    assert found == brute(rows)
    assert any(r[4] == 0 and r[3] < r[1] for r in found)


def test_anchors_in_several_blocks(spark):
    rows = vectors(200, 7)
    assert mined(spark, rows, Settings(block_bytes=300)) == brute(rows)


def test_hot_label_and_copies(spark):
    rows = [(k, [1.0, k % 2 / 2], 1) if k % 3 else (k, [0.5, 0.25], 0) for k in range(400)]
    assert mined(spark, rows, every=50) == brute(rows, every=50) != []


def test_awkward_rows(spark):
    rows = vectors(60, 11) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1), (100, None, 1), (110, [1.0, None, 0.0, 0.0], 1),
        (120, [1.0, float("nan"), 0.0, 0.0], 1), (130, [float("inf")] * 4, 1),
        (140, [1.0, 0.5, 0.2, 0.1], None), (150, [], 1), (160, [1.0, 2.0], 1),
        (20, [0.1, 0.2, 0.3, 0.4], 0), (20, [0.1, 0.2, 0.3, 0.4], 0),
        (161, [0.5, 2.0], 1), (162, [0.25, 1.0], 2)]
    assert mined(spark, rows, more="score anchor id row positive _ok _is_anchor"
                 ) == brute(rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], 1)]) == []
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 1)]) == []
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []


def test_scores_are_exact():
    a = np.array([[2.0**24 + 1, 2.0**24]])
    assert scores(a, a)[0, 0] == (2**24 + 1)**2 + 2**48
    with pytest.raises(ValueError, match="55 bits"):
        scores(a * 2**6, a * 2**6)


def test_windows_must_lie_below_the_positive():
    with pytest.raises(ValueError, match="low < high"):
        Settings(low=30, high=120)
