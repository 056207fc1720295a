"""The driver file imports with and without the optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), 'service_risk_scores' in e.queries())"


def run_in(folder):
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("left_out", [("llm", "corpus_pipeline.py"), ("llm",), ("corpus_pipeline.py",)])
def test_imports_without_the_optional_parts(tmp_path, left_out):
    shutil.copytree(os.path.join(ROOT, "riskweave"), tmp_path / "riskweave", ignore=shutil.ignore_patterns(
        "__pycache__", *left_out))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), tmp_path / name)
    made, has_pipeline, has_flagship = run_in(str(tmp_path))
    assert int(made) >= 143 and has_pipeline == "False" and has_flagship == "True"
