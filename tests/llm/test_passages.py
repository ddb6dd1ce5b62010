import re
import zlib

import pytest
from pyspark.sql import functions as F

from lastro.llm import queries
from lastro.llm.passages import repeated_units, without_repeats
from tests.llm.helpers import awkward, docs, empty, words

FOLD = {c: c + 32 for c in range(65, 91)}
SF = "/root/testdata/sf0.001"


def brute(rows, pattern, least):
    """The unit rule again, over text: (id, start, end, first id)."""
    seen, out = {}, []
    for key, text in sorted((r for r in rows if r[0] is not None and r[1]),
                            key=lambda r: r[0]):
        for m in re.finditer(pattern, text):
            spans = [x.span() for x in re.finditer(r"[^\t-\r ]+", m[0])]
            w = [m[0][a:b].translate(FOLD) for a, b in spans]
            cuts = [0]
            for k in range(len(w)):
                if (len(w) > 40 and k - cuts[-1] >= least and len(w) - k >= least
                        and zlib.crc32(w[k].encode()) % 12 == 0):
                    cuts.append(k)
            for a, b in zip(cuts, [*cuts[1:], len(w)]):
                piece = tuple(w[a:b])
                if len(piece) < least:
                    continue
                place = m.start() + spans[a][0], m.start() + spans[b - 1][1]
                if piece in seen:
                    out.append((key, *place, seen[piece]))
                else:
                    seen[piece] = key
    return sorted(out)


SENTENCE = r"""[^\r\n.!?]+(?:[.!?]+(?![\t-\r "')\]])[^\r\n.!?]+)*[.!?]*["')\]]*"""


def listed(df):
    return sorted((r.doc_id, r.start, r.end, r.first_id) for r in df.collect())


def test_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r[0], r[1]) for r in table.select("doc_id", "text").collect()]
    assert listed(repeated_units(table)) == brute(rows, SENTENCE, 6)
    assert listed(repeated_units(table, "line", 3)) == brute(rows, r"[^\r\n]+", 3)


PARAGRAPH = r"(?:[^\n]|\n(?![ \t\r]*\n))+"


def brute_units(rows):
    """Lines, paragraphs, sentences and their pieces by one rule over text:
    (id, start, end, words, first id, kind) of all that occurred before."""
    seen, out = {}, []
    for key, text in sorted((r for r in rows if r[0] is not None and r[1]),
                            key=lambda r: r[0]):
        found = {}
        for kind, pattern in (("line", r"[^\r\n]+"), ("paragraph", PARAGRAPH),
                              ("sentence", SENTENCE)):
            for m in re.finditer(pattern, text):
                spans = [x.span() for x in re.finditer(r"[^\t-\r ]+", m[0])]
                w = [m[0][a:b].translate(FOLD) for a, b in spans]
                cuts = [0]
                for k in range(len(w) * (kind == "sentence")):
                    if (len(w) > 40 and k - cuts[-1] >= 6 and len(w) - k >= 6
                            and zlib.crc32(w[k].encode()) % 12 == 0):
                        cuts.append(k)
                for a, b in zip(cuts, [*cuts[1:], len(w)]):
                    if b - a >= (6 if kind == "sentence" else 1):
                        found.setdefault((m.start() + spans[a][0], m.start() + spans[b - 1][1]),
                                         (kind, tuple(w[a:b])))
        for (start, end), (kind, unit) in sorted(found.items()):
            if unit in seen:
                out.append((key, start, end, len(unit), seen[unit], kind))
            else:
                seen[unit] = key
    return sorted(out)


def brute_windows(rows):
    """Places of the words that lie in 50 words which occurred before, and the
    ids of the texts that have each 50 words."""
    owners, covered = {}, set()
    for key, text in sorted((r for r in rows if r[0] is not None and r[1]),
                            key=lambda r: r[0]):
        found = list(re.finditer(r"[^\t-\r ]+", text))
        low = [m[0].translate(FOLD) for m in found]
        for k in range(len(low) - 49):
            before = owners.setdefault(tuple(low[k:k + 50]), [])
            if before:
                covered |= {(key, m.start()) for m in found[k:k + 50]}
            before.append(key)
    return covered, owners


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_equals_brute_force_of_all_kinds(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet")
            .select("doc_id", "text").collect()]
    found = queries.op2_passages(spark, folder).collect()
    units = sorted((r.doc_id, r.start, r.end, r.words, r.first_doc_id, r.kind)
                   for r in found if r.kind != "passage")
    assert units == brute_units(rows)
    assert {k for *_, k in units} == {"line", "paragraph", "sentence"}
    texts, (covered, owners) = dict(rows), brute_windows(rows)
    listed = set()
    for r in (r for r in found if r.kind == "passage"):
        words = list(re.finditer(r"[^\t-\r ]+", texts[r.doc_id][r.start:r.end]))
        low = [m[0].translate(FOLD) for m in words]
        assert len(low) == r.words >= 50
        # each 50 words of a passage are also in the text it names, or before in its own
        assert all(r.first_doc_id in owners[tuple(low[k:k + 50])]
                   for k in range(len(low) - 49))
        listed |= {(r.doc_id, r.start + m.start()) for m in words}
    assert listed == covered and covered


def test_a_passage_inside_other_text_is_found(spark):
    passage = ". ".join(words(12, k) for k in range(6)).capitalize() + "."
    rows = [(k, f"{words(20, 100 + k)} {passage} {words(20, 200 + k)}")
            for k in range(4)] + [(9, words(80, 400))]
    found = repeated_units(docs(spark, rows))
    assert {r.doc_id for r in found.collect()} == {1, 2, 3}
    assert found.agg(F.min("first_id"), F.max("first_id")).first() == (0, 0)


def test_a_passage_without_marks_is_found(spark):
    passage = words(55, 1)
    rows = [(k, f"{words(30 + k, 100 + k)} {passage} {words(25, 200 + k)}")
            for k in range(6)] + [(9, words(150, 400))]
    found = repeated_units(docs(spark, rows)).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5}
    text = dict(rows)
    assert all(text[r.doc_id][r.start:r.end] in passage for r in found)


def test_offsets_are_code_points_and_texts_are_cut(spark):
    line = "Ünïcode wörds öf the säme line here"
    table = docs(spark, [(1, f"é first\n{line}\nend"), (2, f"日本 x\n  {line} \nlast"),
                         (3, None), (4, "")], "removed")
    r, = repeated_units(table, "line").collect()
    assert (r.doc_id, r.start, r.end) == (2, 7, 7 + len(line))
    cut = {x.doc_id: x for x in without_repeats(table, "line").collect()}
    assert cut[2].text == "日本 x\n   \nlast"
    assert cut[1].text == f"é first\n{line}\nend" and cut[1].removed == []
    assert [tuple(p) for p in cut[2].removed] == [(7, 7 + len(line))]
    assert cut[3].text is None and cut[4].text == ""


def test_repeats_in_one_text_frequent_lines_and_paragraphs(spark, monkeypatch):
    line = "this very common line of words occurs everywhere"
    rows = [(k, "\n".join([line] * 50 + [words(8, k)])) for k in range(500)]
    found = repeated_units(docs(spark, rows), "line")
    assert found.count() == 50 * 500 - 1
    two = "first of two lines\nand the second one of them"
    table = docs(spark, [(1, f"{two}\n\nown words"), (2, f"other\n\n{two}")])
    assert [r.doc_id for r in repeated_units(table, "paragraph").collect()] == [2]


def test_awkward_rows(spark):
    found = repeated_units(awkward(spark, "unit digest start first_id"))
    assert {r.doc_id for r in found.collect()} >= {2}
    assert 1 not in {r.doc_id for r in found.collect()}
    assert repeated_units(empty(spark)).collect() == []
    assert without_repeats(awkward(spark)).count() == 11
