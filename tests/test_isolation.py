"""The engine without its corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from docfold.plans.queries import QUERIES

REPO = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left_out", [["docfold/llm"], ["docfold/llm", "corpus_pipeline.py"]], ids=len)
def test_entry_imports_without_the_corpus_operators(tmp_path, left_out):
    copy = tmp_path / "copy"
    gone = {str(REPO / name) for name in left_out}
    skip = lambda folder, names: [n for n in names if f"{folder}/{n}" in gone or n in ("__pycache__", ".git")]
    shutil.copytree(REPO / "docfold", copy / "docfold", ignore=skip)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (REPO / name).exists():
            shutil.copy(REPO / name, copy / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split() == [str(len(QUERIES))] * 2
