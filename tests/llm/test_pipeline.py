"""The stages of the pipeline, each held against a plain form of its rule."""

import re

import corpus_pipeline as pipeline
from lastro.llm import mixing, secrets
from lastro.sources.scratch import shared_folder, stage
from lastro.sources.versions import folders
from tests.llm.helpers import awkward, empty
from tests.llm.test_decontaminate import brute as leaked
from tests.llm.test_minhash import brute as near
from tests.llm.test_mixing import true_targets

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_each_stage_does_its_part(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, steps = docs.columns, rows_of(docs), {}
    for name, function in pipeline.STAGES:
        docs = stage(function(spark, docs, SF), "test")
        steps[name] = before, docs
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            before = rows_of(docs)

    old, new = steps["quality classifier"]
    labels = {r.doc_id: r.quality for r in
              spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = rows_of(new)
    good = [k for k in old if labels.get(k) == 1]
    bad = [k for k in old if labels.get(k) == 0]
    assert sum(k in kept for k in good) >= 0.97 * len(good)
    assert sum(k in kept for k in bad) <= 0.1 * len(bad)
    assert all(kept[k] == old[k] for k in kept)

    old, new = steps["minhash near-dedup"]
    true = near([(k, r.text) for k, r in old.items()], 5)
    assert set(rows_of(new)) == {k for k in true if true[k][2]} != set(old)

    old, new = steps["benchmark decontamination"]
    items = [(str(r.item_id), r.text) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {k for k, r in old.items() if leaked(r.text, items, 10)[1]}
    assert set(rows_of(new)) == set(old) - dirty

    old, new = steps["secret scans"]
    found = rows_of(new)
    assert set(found) == set(old)
    for k, r in found.items():
        assert not [s for s in secrets.base_spans(r.text)]
        assert r.n_chars == len(r.text)
        if not secrets.base_spans(old[k].text) and "[SECRET]" not in r.text:
            assert r == old[k]

    old, new = steps["mixing sources"]
    totals, taken = {}, {}
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for k, r in old.items()}
    for k, r in old.items():
        totals[r.source] = totals.get(r.source, 0) + size[k]
    copies = {}
    for r in new.collect():
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id]
        copies.setdefault(r.doc_id, []).append(r.copy)
        assert r.text == old[r.doc_id].text
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 2
               for c in copies.values())
    for source, target in true_targets(totals).items():
        # whole copies of a handful of documents come no nearer than this
        largest = max(size[k] for k, r in old.items() if r.source == source)
        assert abs(taken.get(source, 0) - target) <= max(0.02 * target, largest / 2)


def test_awkward_rows_pass_every_stage(spark):
    for docs in (awkward(spark, "score predicted copy found _gone"), empty(spark)):
        columns = docs.columns
        for name, function in pipeline.STAGES[:-1]:
            out = stage(function(spark, docs, SF), "test")
            assert out.columns == columns, name
            if name in ("benchmark decontamination", "secret scans"):
                assert out.count() == docs.count()
        mixed = mixing.apply_mix(docs)
        assert set(mixed.columns) == {*columns, "copy"}
        copies = {}
        for r in mixed.collect():
            copies.setdefault((r.doc_id, r.source, r.text), []).append(r.copy)
        rows = {}
        for r in docs.collect():
            if r.text and r.text.split():
                rows[r.doc_id, r.source, r.text] = rows.get((r.doc_id, r.source, r.text), 0) + 1
        assert set(copies) <= set(rows)
        assert all(len(c) <= 2 * rows[k] for k, c in copies.items())
        assert bool(copies) == bool(rows)


def test_run_leaves_its_result_only(spark):
    assert pipeline.ORACLE_SQL is None
    before = set(folders(spark, shared_folder(spark)))
    result = pipeline.run(spark, SF)
    assert result.count() > 50
    left = set(folders(spark, shared_folder(spark))) - before
    assert [p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in left] == ["mixing-sources"]
