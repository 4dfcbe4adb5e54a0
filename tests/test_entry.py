"""The entry module works without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_entry_without_the_subpackage(tmp_path):
    shutil.copytree(REPO / "folioforge", tmp_path / "folioforge", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and not [q for q in e.queries() if q.startswith('op')]; assert set(e.oracle_sql()) <= set(e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
