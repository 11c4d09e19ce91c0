"""The driver's entry module with and without the training-data operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(len(e.queries()), *sorted(e.queries()))"


def names(folder) -> list[str]:
    out = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()[1:]


def copy(to, *left_out) -> str:
    skipped = {os.path.join(REPO, p) for p in left_out}
    shutil.copytree(REPO, to, ignore=lambda at, found: [
        f for f in found if os.path.join(at, f) in skipped or f in (".git", "__pycache__")])
    return str(to)


def test_loads_without_the_training_data_operators(tmp_path):
    kept = names(copy(tmp_path / "a", "basketry/llm", "tests/llm"))
    assert "fct_customers" in kept and "pipeline" not in kept
    assert names(copy(tmp_path / "b", "basketry/llm", "tests/llm", "corpus_pipeline.py")) == kept
    assert not any(name.startswith("op") and name[2:3].isdigit() for name in kept)
