import random

import numpy as np

from lastro.llm.components import connected_components
from lastro.llm import minhash
from lastro.llm.minhash import Settings, deduplicate, near_duplicates, shingle_hashes
from lastro.sources.scratch import Scratch
from tests.llm.helpers import awkward, docs, empty, words


def brute_sets(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, width):
    sets = {k: brute_sets(t, width) for k, t in rows}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    component = roots(ids, links)
    return {k: (len(sets[k]), component[k], component[k] == k) for k in ids}


def result(df):
    return {r[0]: (r[1], r[2], r[3]) for r in df.collect()}


def test_equals_brute_force_on_edited_copies(spark):
    chance = random.Random(5)
    rows = []
    for base in range(12):
        source = words(60, base).split()
        for copy in range(12):
            edited = list(source)
            for _ in range(chance.choice([0, 0, 1, 2, 3, 5, 8])):
                edited[chance.randrange(len(edited))] = f"new{chance.random()}"
            rows.append((len(rows) * 3 % 431, " ".join(edited)))
    for width in (2, 5):
        found = result(near_duplicates(docs(spark, rows), Settings(width=width)))
        assert found == brute(rows, width)
        assert sum(not kept for _, _, kept in found.values()) > 20


def test_a_chain_is_one_component_though_its_ends_differ(spark):
    text = words(200, 1).split()
    chain = [" ".join(text[k * 10:k * 10 + 120]) for k in range(9)]
    rows = list(enumerate(chain))
    assert result(near_duplicates(docs(spark, rows), Settings(width=2))) == brute(rows, 2)
    assert len(brute_sets(chain[0], 2) & brute_sets(chain[8], 2)) < 80


def test_blocks_and_salts_change_nothing(spark, monkeypatch):
    chance = random.Random(8)
    source = words(40, 3).split()
    rows = []
    for k in range(150):
        edited = list(source)
        for _ in range(chance.choice([0, 3, 4, 5, 6])):
            edited[chance.randrange(len(edited))] = f"n{chance.random()}"
        rows.append((k, " ".join(edited)))
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "SET_BLOCK", 8)
    join = minhash.spread_join
    monkeypatch.setattr(minhash, "spread_join", lambda a, b, key, how="inner": join(
        a, b, key, how, rows_per_task=10))
    assert result(near_duplicates(docs(spark, rows), Settings(width=2))) == brute(rows, 2)


def test_words_are_parted_by_ascii_blanks_and_only_a_to_z_folds():
    assert (shingle_hashes("A\x0bB".encode(), 2) == shingle_hashes(b"a b", 2)).all()
    assert len(shingle_hashes("a b".encode(), 2)) == 1  # one word
    assert (shingle_hashes("É x".encode(), 2) != shingle_hashes("é x".encode(), 2)).all()
    assert len(shingle_hashes(b" \t\n", 2)) == 0
    # one word is a shingle of its own, not the pair of it
    assert shingle_hashes(b"a", 2)[0] != shingle_hashes(b"a a", 2)[0]


def test_awkward_rows(spark):
    rows = near_duplicates(awkward(spark, "component_id kept id sig"),
                           Settings(width=2)).collect()
    assert rows and len(rows) == 11
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[2] == [(9, 1, False)] * 2
    assert by_id[1] == [(9, 1, True)]
    assert by_id[3] == by_id[4] == [(0, 3, True)] or by_id[3] == [(0, 3, True)]
    assert by_id[5] == [(0, 5, True)]
    assert sorted(by_id[None], key=str) == [(0, None, False), (9, None, False)] or all(
        c is None and k for _, c, k in by_id[None])
    assert near_duplicates(empty(spark)).collect() == []


def test_an_id_with_two_texts_joins_their_groups(spark):
    a, b = words(30, 1), words(30, 2)
    rows = [(5, a), (5, b), (7, a), (9, b), (8, words(30, 3))]
    found = {(r[0], r[2]) for r in near_duplicates(docs(spark, rows)).collect()}
    assert found == {(5, 5), (7, 5), (9, 5), (8, 8)}


def test_deduplicate_keeps_one_row_of_each_group(spark):
    kept = deduplicate(awkward(spark, "_gone copies")).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 1, 3, 4, 5, 6, 7, 8]
    twice = docs(spark, [(1, "one two three"), (1, "one two three"), (2, None)])
    assert sorted(r.doc_id for r in deduplicate(twice).collect()) == [1, 2]
    assert kept[0].asDict().keys() == set(awkward(spark, "_gone copies").columns)


def test_components_equal_union_find(spark):
    chance = random.Random(1)
    edges = [(chance.randrange(300), chance.randrange(300)) for _ in range(200)]
    edges += [(k, k + 1) for k in range(400, 460)] + [(7, 7), (1000, 5), (1000, 5)]
    edges += [(900, 900 + k) for k in range(1, 200)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    with Scratch(spark) as scratch:
        found = {r[0]: r[1] for r in connected_components(df, scratch, "t").collect()}
        nothing = spark.createDataFrame([], "a long, b long")
        assert connected_components(nothing, scratch, "n").collect() == []
    true = roots({x for e in edges for x in e}, edges)
    assert all(found.get(n, n) == c for n, c in true.items())
    assert len(set(found)) == len(found)


def test_signature_estimates_similarity():
    factor, offset = minhash.hash_family(160)
    values = np.random.default_rng(2).integers(0, 2**63, 2000, np.uint64)
    a = minhash.signature(np.sort(values[:1800]), factor, offset)
    b = minhash.signature(np.sort(values[200:]), factor, offset)
    assert abs((a == b).mean() - 0.8) < 0.12
