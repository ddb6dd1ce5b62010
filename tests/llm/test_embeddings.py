import math

import numpy as np
import pytest

from lastro.llm import embeddings, queries
from lastro.llm.embeddings import Settings, Tree, missed_pairs, near_duplicates
from tests.llm.test_minhash import roots

SCHEMA = "vec_id long, embedding array<float>"


def clusters(seed=1, groups=40, each=12, size=16):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        centre = random.normal(size=size)
        for _ in range(each):
            noise = random.normal(size=size) * random.choice([0, 0.05, 0.15, 0.25, 0.35])
            rows.append((len(rows), (centre + noise).astype(np.float32).tolist()))
    return rows


def brute(rows, least=0.95):
    ok = {}
    for key, v in rows:
        x = np.array([math.nan if c is None else c for c in v or []], float)
        if len(x) and np.isfinite(x).all() and x.any():
            ok[key] = x / np.linalg.norm(x)
    links = [(a, b) for a in ok for b in ok if a < b and len(ok[a]) == len(ok[b])
             and float(ok[a] @ ok[b]) >= least]
    component = roots([k for k, _ in rows], links)
    return {k: (sum(k in p for p in links), component[k]) for k, _ in rows}


def result(df):
    return {r[0]: (r.n_links, r.component_id) for r in df.collect()}


def test_equals_brute_force(spark):
    rows = clusters()
    df = spark.createDataFrame(rows, SCHEMA)
    found = near_duplicates(df)
    assert result(found) == brute(rows)
    assert embeddings.recall(df, found) == 1.0
    assert sum(n for n, _ in brute(rows).values()) > 500


def test_many_leaves_and_blocks_keep_the_links(spark, monkeypatch):
    rows = clusters(seed=2, groups=80, each=10, size=32)
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(embeddings, "BLOCK", 20)
    found = result(near_duplicates(df, Settings(leaf=40, spill=0.05)))
    true = brute(rows)
    counted, there = sum(n for n, _ in found.values()), sum(n for n, _ in true.values())
    assert 0.97 * there <= counted <= there
    assert all(found[k][0] <= true[k][0] for k in true)


def test_equal_vectors_and_tight_groups(spark):
    random = np.random.default_rng(3)
    base = random.normal(size=8)
    rows = [(k, base.astype(np.float32).tolist()) for k in range(700)]
    rows += [(700 + k, (base + random.normal(size=8) * 1e-3).astype(np.float32).tolist())
             for k in range(300)]
    rows += [(2000 + k, random.normal(size=8).astype(np.float32).tolist()) for k in range(50)]
    assert result(near_duplicates(spark.createDataFrame(rows, SCHEMA),
                                  Settings(leaf=50))) == brute(rows)


def test_awkward_rows(spark):
    nan, inf = math.nan, math.inf
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, [2.0, 4.0, 6.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]),
            (6, [nan, 1.0, 2.0]), (7, [inf, 1.0, 1.0]), (8, [None, 1.0, 1.0]),
            (9, [1.0, 2.0]), (10, [0.5, 1.0]), (11, [-1.0, -2.0, -3.0]),
            (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30])]
    df = spark.createDataFrame(rows, SCHEMA)
    found = result(near_duplicates(df))
    assert found == brute(rows)
    assert found[1] == (3, 1) and found[9] == (1, 9)
    repeated = spark.createDataFrame(
        [(1, v), (1, v), (2, v), (None, v), (None, None)], SCHEMA)
    repeated = repeated.selectExpr("*", "'x' AS n_links", "'y' AS id", "'z' AS unit")
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id)
                  for r in near_duplicates(repeated).collect()), key=str)
    assert got == [(0, 0, None), (0, 0, None), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    found = queries.op9_embeddings(spark, "/root/testdata/sf0.001")
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert found.count() == 500


def unit_rows(random, rows, size):
    x = random.normal(size=(rows, size))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("size, total", [(64, 51_282), (384, 300_000), (768, 51_282),
                                         (1024, 20_000)])
def test_copies_do_not_grow_with_the_dimension(size, total):
    random = np.random.default_rng(size)
    sample, settings = unit_rows(random, 3000, size), Settings()
    trees = [Tree.grow(sample, total, settings, random) for _ in range(settings.trees)]
    fresh = unit_rows(random, 500, size)
    copies = sum(len(t.find(fresh)[0]) for t in trees) / len(fresh)
    assert 4 <= copies <= 20
    assert missed_pairs(sample, trees, settings.cosine, random) <= 0.01


def test_grafted_leaves_take_the_place_of_others():
    random = np.random.default_rng(4)
    sample, settings = unit_rows(random, 400, 8), Settings(leaf=50)
    tree = Tree.grow(sample, 400, settings, random)
    part = {leaf: Tree.grow(sample[:100], 100, Settings(leaf=20), random)
            for leaf in (0, tree.leaves - 1)}
    whole = tree.graft(part)
    before, after = tree.find(sample), whole.find(sample)
    other = ~np.isin(before[1], list(part))
    kept = set(zip(before[0][other].tolist(), before[1][other].tolist()))
    assert kept == {p for p in zip(*(x.tolist() for x in after)) if p[1] < tree.leaves}
    moved = {(r, leaf) for r, leaf in zip(*(x.tolist() for x in before)) if leaf in part}
    assert {r for r, _ in moved} == {r for r, leaf in zip(*(x.tolist() for x in after))
                                     if leaf >= tree.leaves}
    alone = Tree.grow(sample[:5], 5, settings, random)  # a leaf, and no node
    assert alone.root == -1 and alone.find(sample)[1].max() == 0
    assert alone.graft({0: part[0]}).root == 0
    assert alone.graft({0: alone}).closed[0]


def test_leaves_are_bounded_whatever_the_sample(spark, monkeypatch):
    random = np.random.default_rng(6)
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(unit_rows(random, 6000, 16))]
    monkeypatch.setattr(embeddings, "SAMPLE_VECTORS", 150)
    monkeypatch.setattr(embeddings, "LEAF_SAMPLE", 200)
    units = embeddings.unit_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id",
                                    "embedding").cache()
    settings = Settings(leaf=60, trees=2, most_trees=2)
    trees = embeddings.fit_forest(units, settings)[16]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for tree in trees:
        row, leaf = tree.find(x)
        assert set(row.tolist()) == set(range(6000))
        assert np.bincount(leaf).max() <= 2 * settings.leaf
        assert not tree.closed[np.unique(leaf)].any()
    units.unpersist()


def test_vectors_that_split_keep_their_links(spark):
    rows = clusters(seed=9, groups=1600, each=12, size=64)
    table = spark.createDataFrame(rows, SCHEMA)
    found = near_duplicates(table).cache()
    assert found.count() == len(rows) == 19_200
    assert 0.99 <= embeddings.recall(table, found, queries=2000) <= 1.0
    assert found.where("n_links > 0").count() > 5000
    units = embeddings.unit_vectors(table, "vec_id", "embedding")
    assert all(t.leaves > 20 for t in embeddings.fit_forest(units, Settings())[64])
    found.unpersist()
