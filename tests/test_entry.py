"""The entry module without the training-data subpackage."""

import shutil
import subprocess
import sys

from conftest import ROOT


def test_imports_without_the_training_data_operators(tmp_path):
    shutil.copytree(f"{ROOT}/innflow", tmp_path / "innflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) >= 40 and set(e.oracle_sql()) == set(q); assert 'pipeline' not in q"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
