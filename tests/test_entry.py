"""The driver contract, with and without the numbered operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
ASK = "import __spark_entry__ as e; print('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_imports_without_the_numbered_operators(tmp_path: Path, pipeline_too: bool) -> None:
    shutil.copytree(ROOT / "corpusmill", tmp_path / "corpusmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if not pipeline_too and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    said = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True).stdout
    names, sql = (set(line.split()[1:]) for line in said.splitlines() if line[:3] in ("NAM", "SQL"))
    assert "corpus_packed_index" in names and sql <= names
    assert not [n for n in names if n.startswith("op") or n == "pipeline"]


def test_import_errors_inside_the_operators_are_passed_on(tmp_path: Path) -> None:
    shutil.copytree(ROOT / "corpusmill", tmp_path / "corpusmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpusmill/llm").mkdir()
    (tmp_path / "corpusmill/llm/__init__.py").write_text("")
    (tmp_path / "corpusmill/llm/queries.py").write_text("import no_such_module\n")
    run = subprocess.run([sys.executable, "-B", "-c", ASK], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert run.returncode and "no_such_module" in run.stderr
