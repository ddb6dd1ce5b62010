"""Collocations against a brute-force version, and the summaries' guarantee."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from lastro.llm import queries
from lastro.llm.phrases import Settings, Summary, _Filter, collocations, score
from tests.llm.helpers import awkward, docs, empty

SF = "/root/testdata/sf0.01"


def brute(rows, settings=Settings()):
    """Rows of (lang, text) to those of ``collocations``."""
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(words)
            for k in range(1, settings.longest + 1):
                counts.update((lang, tuple(words[i:i + k]))
                              for i in range(len(words) - k + 1))
    frequent = {x: f for x, f in counts.items() if f >= settings.least}
    inside = Counter()
    for (lang, words), f in frequent.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = lang, words[i:i + k]
                inside[part] = max(inside[part], f)
    found = {}
    for (lang, words), a in frequent.items():
        if len(words) < 2 or 100 * inside[lang, words] >= settings.covered * a:
            continue
        cuts = [(1000 * a * sizes[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]),
                 k) for k in range(1, len(words))]
        best, k = min(cuts)
        found.setdefault(lang, []).append(
            (-best, -a, " ".join(words).encode(), counts[lang, words[:k]],
             counts[lang, words[k:]]))
    return sorted((lang, rank + 1, phrase.decode(), -a, left, right, sizes[lang], -best)
                  for lang, rows in found.items() for rank, (best, a, phrase, left, right)
                  in enumerate(sorted(rows)[:settings.listed]))


def mined(table, settings=Settings(), **columns):
    return sorted(tuple(r) for r in collocations(table, settings, **columns).collect())


def corpus(count, seed, vocabulary=6):
    chance = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["The", "ÉTÉ", "\xa0x", "a_b", "日本"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".\n", "! ", "\r\n", ";"]
    return [(k, "".join(chance.choice(words) * (chance.random() < .98) + chance.choice(ends)
                        for _ in range(chance.randrange(60)))) for k in range(count)]


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    result = queries.op11_phrases(spark, SF)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in result.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    rows = [tuple(r) for r in table.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in result.collect()) == brute(rows) != []


@pytest.mark.parametrize("settings", [
    Settings(least=4), Settings(least=9, counters=16, listed=7),
    Settings(least=6, covered=50, counters=8), Settings(least=5, longest=3, counters=4),
    Settings(least=5, longest=2), Settings(least=12, counters=4, filter_bytes=64)])
def test_small_summaries_lose_nothing(spark, settings):
    rows = corpus(250, settings.least)
    table = docs(spark, rows)
    assert mined(table, settings) == brute([("en", t) for _, t in rows], settings) != []


def test_one_text_holds_a_third(spark):
    rows = [(k, "one line that comes again") for k in range(400)] + corpus(100, 3) + [
        (1000, "again and again " * 20_000)]
    found = mined(docs(spark, rows), Settings(least=50))
    assert found == brute([("en", t) for _, t in rows], Settings(least=50))
    assert any(r[2] == "again and again again and" for r in found)


def test_awkward_rows(spark):
    settings = Settings(least=3)
    table = awkward(spark, "key words phrase f n l r score rank count")
    rows = [(r["lang"], r["text"]) for r in table.collect()]
    found = mined(table, settings)
    assert found == brute(rows, settings)
    assert {r[0] for r in found} == {"en"}
    again = mined(table.union(table), settings)
    assert again == brute(rows * 2, settings) and {r[0] for r in again} == {"en", "und"}


def test_empty_table(spark):
    assert mined(empty(spark)) == []
    assert mined(docs(spark, [(1, None), (2, ""), (3, " \n.")]), Settings(least=1)) == []


@pytest.mark.parametrize("capacity", [1, 5, 40])
def test_summaries_keep_what_is_frequent(capacity):
    random_ = np.random.default_rng(capacity)
    stream = np.concatenate([np.repeat(np.arange(5), 120), random_.integers(5, 4000, 6000)])
    random_.shuffle(stream)
    summary = Summary(capacity, 100)
    for part in np.split(stream.astype(np.uint32), 33):
        grams, counts = np.unique(part, return_counts=True)
        summary.merge(grams, counts)
    true = Counter(stream.tolist())
    assert {g for g, f in true.items() if f >= 100} <= set(summary.survivors().tolist())
    assert summary.taken < 100
    for gram, count in zip(summary.grams.tolist(), summary.counts.tolist()):
        assert true[gram] - summary.taken <= count <= true[gram]


def test_capacity_above_mass_by_threshold_is_enough():
    stream = np.random.default_rng(1).integers(0, 3000, 20_000).astype(np.uint32)
    summary = Summary(20_000 // 100 + 1, 100)
    for part in np.split(stream, 100):
        summary.merge(*np.unique(part, return_counts=True))
    summary.settle()
    assert summary.capacity == 201 and len(summary.grams) <= 201


@pytest.mark.parametrize("most", [64, 4096, 1 << 22])
def test_filters_hold_all_within_their_size(most):
    hashes = np.random.default_rng(most).integers(0, 2**63, 3000).astype(np.uint64) * 2
    bits = _Filter.bits(3000, 8, most)
    assert 8 * bits // 8 <= max(most, 64)
    known = _Filter(8, np.zeros((8, bits // 8), np.uint8))
    from lastro.llm.phrases import _placed
    part, gram = _placed(hashes, 3)
    for places in _Filter.places(gram, bits):
        np.bitwise_or.at(known.segments, (part, places >> 3),
                         (1 << (places & 7)).astype(np.uint8))
    assert known.has(hashes).all()
    if most > 4096:
        others = np.random.default_rng(7).integers(0, 2**63, 20_000).astype(np.uint64)
        assert known.has(others).mean() < .02


def test_scores_pass_64_bits(spark):
    rows = [(10**15, 9 * 10**15, 10**15 + 7, 10**15 + 1), (100, 10**14, 100, 101),
            (100, 3, 7, 1), (999_999_999_999, 10**13, 10**12, 10**12)]
    table = spark.createDataFrame(rows, "a long, n long, l long, r long")
    assert [r[0] for r in table.select(score("a", "n", "l", "r")).collect()] == [
        1000 * a * n // (left * right) for a, n, left, right in rows]
