"""The rest of the library without the corpus operators: a copy of the tree without their folders."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_llm(tmp_path):
    from marlstone.plans import corpus

    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", "*.json"))
    code = "import __spark_entry__ as e; q = e.queries(); assert not any(k.startswith('op') or k == 'pipeline' for k in q), q; assert set(e.oracle_sql()) <= set(q); print(len(q))"
    env = os.environ | {"PYTHONPATH": str(tmp_path / "repo")}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    assert int(got.stdout) == len(corpus.queries())
