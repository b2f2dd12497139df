"""The driver contract with and without the optional part."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as contract

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [("caselume/llm", "tests/llm"), ("caselume/llm", "tests/llm", "corpus_pipeline.py")])
def test_other_queries_register_without_the_optional_part(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse"))
    for name in gone:
        path = copy / name
        if path.exists():
            shutil.rmtree(path) if path.is_dir() else path.unlink()
    code = "import __spark_entry__ as c; print(sorted(c.queries())); assert set(c.oracle_sql()) <= set(c.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    want = sorted(n for n in contract.queries() if not (n.startswith("op") and n.split("_")[0][2:].isdigit()) and n != "pipeline")
    assert done.stdout.strip() == str(want) and len(want) > 80
