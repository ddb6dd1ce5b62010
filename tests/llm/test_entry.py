"""How the corpus queries are registered and reached."""

import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as driver
import corpus_pipeline
from lastro.llm import queries

ROOT = Path(__file__).resolve().parents[2]


def test_each_operator_has_one_query():
    names = sorted(queries.queries())
    assert sorted(n.split("_")[0] for n in names) == sorted(
        [f"op{k}" for k in range(1, 14)] + ["pipeline"])
    assert set(names) <= set(driver.queries())
    assert set(queries.oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "minhash near-dedup", "benchmark decontamination",
        "secret scans", "mixing sources"]


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
            "import __spark_entry__ as e\n"
            "from lastro.session import local_session\n"
            "spark = local_session(2, memory='1g')\n"
            "print('rows', e.queries()['op6_tokens']"
            "(spark, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
