"""The rest of the library works where the removable subpackage is gone."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_subpackage(tmp_path, pipeline):
    there = tmp_path / "repo"
    shutil.copytree(ROOT, there, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "*.md", *([] if pipeline else ["corpus_pipeline.py"])))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert len(q) > 40 and set(o) <= set(q) and not [n for n in q if n[:2] == 'op' and n[2].isdigit() or n == 'pipeline']"
    subprocess.run([sys.executable, "-c", code], cwd=there, check=True, env={**os.environ, "PYTHONPATH": str(there)}, timeout=300)
