"""The rest of the library without the folders of the training-data operators."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SAYS = "import json, bench, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.mark.parametrize("gone", [["factloom/llm", "tests/llm"], ["factloom/llm", "tests/llm", "corpus_pipeline.py"]])
def test_queries_without_the_llm_folders(tmp_path, gone):
    here = tmp_path / "copy"
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        path = here / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    run = subprocess.run([sys.executable, "-c", SAYS], cwd=here, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    queries, sql = json.loads(run.stdout.splitlines()[-1])
    assert len(queries) >= 35 and set(sql) <= set(queries)
    assert not [q for q in queries if q.startswith("op") and q[2:3].isdigit() or q == "pipeline"]
