"""The entry module in a copy of the repository without the training-data folder."""

import os
import shutil
import subprocess
import sys

import pytest

TOP = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LISTED = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_queries_without_the_training_data_folder(tmp_path, with_pipeline):
    from tillroll.plans import ORACLE, QUERIES

    left_out = {"llm", "__pycache__"} | (set() if with_pipeline else {"corpus_pipeline.py"})
    top = tmp_path / "copy"
    top.mkdir()
    shutil.copytree(f"{TOP}/tillroll", top / "tillroll", ignore=shutil.ignore_patterns(*left_out))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(f"{TOP}/{name}"):
            shutil.copy(f"{TOP}/{name}", top)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", LISTED], cwd=top, env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    assert out.stdout.splitlines() == [str(sorted(QUERIES)), str(sorted(ORACLE))]
