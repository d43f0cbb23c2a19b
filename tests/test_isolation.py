"""The library works without the operators for training data."""

from __future__ import annotations

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_entry_imports_without_them(tmp_path, pipeline):
    left_out = ["llm", ".git", "*warehouse*", "__pycache__"] + ["corpus_pipeline.py"] * (not pipeline)
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(*left_out))
    code = "import __spark_entry__ as e; names = set(e.queries()); assert names == set(e.oracle_sql()) and 'inbox' in names; print(len(names))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout) >= 42, done.stderr


def test_nothing_else_imports_them():
    files = [p for folder in ("mailspark", "tests") for p in (ROOT / folder).rglob("*.py") if "llm" not in p.parts and p != Path(__file__).resolve()]
    assert [p for p in files if re.search(r"mailspark\.llm|from mailspark import llm|corpus_pipeline", p.read_text())] == []
