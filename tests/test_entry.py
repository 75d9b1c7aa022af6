"""The rest of the library without the corpus folders."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_corpus_folders(tmp_path, pipeline):
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{REPO}/tarn", tmp_path / "tarn", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if pipeline and os.path.exists(f"{REPO}/corpus_pipeline.py"):
        shutil.copy(f"{REPO}/corpus_pipeline.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "A1_fact_summary" in names and "pipeline" not in names and not [n for n in names if n.startswith("op")]


def test_an_error_inside_a_present_folder_is_not_swallowed(tmp_path):
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{REPO}/tarn", tmp_path / "tarn", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "tarn/llm").mkdir()
    (tmp_path / "tarn/llm/__init__.py").write_text("")
    (tmp_path / "tarn/llm/queries.py").write_text("import no_such_module_here\n")
    out = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode and "no_such_module_here" in out.stderr
