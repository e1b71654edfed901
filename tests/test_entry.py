"""The entry module keeps to its contract, with the llm subpackage or without."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(entry.__file__).parent


def test_entry_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_llm_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "strataquery"):
        source = REPO / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()))"
    ran = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120, check=False)
    assert ran.stdout.split()[-1:] == ["False"], ran.stderr[-500:]


def test_entry_imports_without_a_session():
    """Nothing at the top of a module asks for a running Spark."""
    root = Path(__file__).resolve().parent.parent
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
