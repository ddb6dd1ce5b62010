import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lastro.llm import queries
from lastro.llm.decontaminate import Matcher, decontaminate, find_passages, words_of
from tests.llm.helpers import awkward, docs, empty, words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(text, items, window):
    w = WORD.findall((text or "").translate(FOLD))
    hit, found = set(), set()
    for key, item in items:
        own = WORD.findall((item or "").translate(FOLD))
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if own else 0):
            for at in range(len(w) - n + 1):
                if w[at:at + n] == own[k:k + n]:
                    hit |= set(range(at, at + n))
                    found.add(key)
    return len(w), hit, found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab é.B", max_size=24), max_size=4), st.text("ab é.BX", max_size=60),
       st.integers(1, 4))
def test_scan_equals_brute_force(items, text, window):
    keyed = [(str(k), t) for k, t in enumerate(items)]
    matcher = Matcher.of([(k, t.encode()) for k, t in keyed], window)
    w = words_of(text.encode())
    runs, found = matcher.scan(w)
    n, hit, true = brute(text, keyed, window)
    assert (len(w), {p for s, e in runs for p in range(s, e)}, found) == (n, hit, true)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string")


@pytest.mark.parametrize("block_bytes", [10**6, 100])
def test_spans_map_to_the_original_text(spark, block_bytes):
    items = [("q1", words(14, 1)), ("q2", words(30, 2)), ("q3", "only three words"),
             (None, words(12, 3)), ("q4", None), ("q1", words(14, 1))]
    text = f"Été — {words(14, 1).upper()}; x ONLY, three  words! {words(30, 2)[40:]}"
    table = docs(spark, [(1, text), (2, words(40, 9)), (3, words(12, 3))], "found items")
    rows = {r.doc_id: r.found for r in find_passages(
        table, benchmark(spark, items), block_bytes=block_bytes).collect()}
    n, hit, found = brute(text, [i for i in items if i[0]], 10)
    assert (rows[1].n_words, rows[1].n_hit, set(rows[1]["items"])) == (n, len(hit), found)
    assert found == {"q1", "q2", "q3"}
    for span in rows[1].spans:
        own = WORD.findall(text[span.start:span.end].translate(FOLD))
        every = WORD.findall(text.translate(FOLD))
        assert own == every[span.first_word:span.last_word + 1]
    assert rows[2].n_hit == rows[3].n_hit == 0 and rows[3].spans == []


def test_awkward_rows(spark):
    table = awkward(spark, "found spans")
    rows = find_passages(table, benchmark(spark, [("a", "word"), ("b", "")])).collect()
    assert len(rows) == 11
    assert {r.doc_id for r in rows if r.found.n_hit} == {7}
    nothing = find_passages(table, benchmark(spark, [])).collect()
    assert all(r.found.n_hit == 0 for r in nothing)
    assert find_passages(empty(spark), benchmark(spark, [("a", "b")])).collect() == []
    clean = decontaminate(table, benchmark(spark, [("a", "word")]))
    assert clean.columns == table.columns and clean.count() == 10


def test_query_digest(spark):
    row = queries.op5_decontamination(spark, "/root/testdata/sf0.001").where(
        "NOT contaminated").first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest()
