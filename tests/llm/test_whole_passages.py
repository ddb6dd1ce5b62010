"""Passages that a least word count or a chance cut would hide."""

import random
import re

from lastro.llm.passages import repeated_passages, without_repeats
from tests.llm.helpers import awkward, docs, empty, words


def spans(df):
    return {(r.doc_id, r.start, r.end, r.first_id) for r in df.collect()}


def test_short_lines_and_lines_without_blanks_are_listed_and_cut(spark):
    lines = ["les.", "All rights reserved.", "One two. Three four. Five six. Seven.",
             "这是一个没有空格的句子", "ไม่มีช่องว่าง"]
    rows = [(k, "\n".join(f"{words(7, 10 * k + j)}\n {line} " for j, line
                          in enumerate(lines))) for k in (1, 2)]
    table = docs(spark, rows)
    text = rows[1][1]
    assert spans(repeated_passages(table)) == {
        (2, text.index(line), text.index(line) + len(line), 1) for line in lines}
    kept = {r.doc_id: r.text for r in without_repeats(table).collect()}
    assert kept[1] == rows[0][1]
    assert not any(line in kept[2] for line in lines) and words(7, 23) in kept[2]


def test_paragraphs_are_listed_whole(spark):
    two = f"{words(30, 1)}\n{words(30, 2)}"
    text = f"other\n \t\n{two}"
    table = docs(spark, [(1, f"{two}\n\nown"), (2, text)])
    found = {(r.start, r.end, r.kind) for r in repeated_passages(table).collect()}
    assert (text.index(two), len(text), "paragraph") in found


def test_random_passages_are_found_to_their_ends(spark):
    chance = random.Random(5)
    rows, wanted = [], set()
    for k in range(300):
        passage = words(chance.randrange(51, 120), 3 * k + 5000)
        for copy in (0, 1):
            before, after = (words(chance.randrange(10, 60), 90_000 + 4 * k + 2 * copy + j)
                             for j in (0, 1))
            rows.append((2 * k + copy, f"{before} {passage}\n{after}"))
        wanted.add((2 * k + 1, len(before) + 1, len(before) + 1 + len(passage), 2 * k))
    found = repeated_passages(docs(spark, rows)).where("kind = 'passage'")
    assert spans(found) == wanted


def test_passages_equal_all_windows_of_50_words(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen, covered = {}, set()
    for key, text in sorted((r[0], r[1] or "") for r in
                            table.select("doc_id", "text").collect()):
        found = [m for m in re.finditer(r"[^\t-\r ]+", text)]
        low = [m[0].encode().lower() for m in found]
        for k in range(len(low) - 49):
            if seen.setdefault(tuple(low[k:k + 50]), (key, k)) != (key, k):
                covered |= {(key, m.start()) for m in found[k:k + 50]}
    texts = dict(table.select("doc_id", "text").collect())
    listed = {(r.doc_id, r.start + m.start())
              for r in repeated_passages(table).where("kind = 'passage'").collect()
              for m in re.finditer(r"[^\t-\r ]+", texts[r.doc_id][r.start:r.end])}
    assert listed == covered and covered


def test_a_passage_without_blanks_is_found(spark):
    passage = "".join(chr(0x4E00 + 37 * k % 3000) for k in range(60))
    rows = [(1, f"前{passage}后 one"), (2, f"é 左{passage}右 two")]
    found = repeated_passages(docs(spark, rows)).where("kind = 'passage'")
    assert spans(found) == {(2, 3, 63, 1)}


def test_awkward_rows(spark):
    found = repeated_passages(awkward(spark, "unit digest start kind print at"))
    assert {r.doc_id for r in found.collect()} >= {2, 6}
    assert repeated_passages(empty(spark)).collect() == []
