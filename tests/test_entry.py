"""The library without its optional part."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [False, True])
def test_entry_without_the_corpus_operators(tmp_path, pipeline):
    """Also if the pipeline's file is still there."""
    for name in ("guidepost", "workload"):
        shutil.copytree(
            os.path.join(ROOT, name), tmp_path / name, ignore=shutil.ignore_patterns("llm")
        )
    names = ["__spark_entry__.py", "bench.py"]
    if pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        names.append("corpus_pipeline.py")
    for name in names:
        shutil.copy(os.path.join(ROOT, name), tmp_path)
    code = "import __spark_entry__ as e, bench; print(*e.queries(), *e.oracle_sql())"
    found = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
        env=os.environ | {"PYTHONPATH": ""},
    )
    assert found.returncode == 0, found.stderr
    names = found.stdout.split()
    assert "resolve_paths_window" in names
    assert not any(name == "pipeline" or name.startswith("op1_") for name in names)
