"""The driver contract, with and without the training-data subpackage."""

import shutil
import subprocess
import sys

from conftest import ROOT


def _names(folder):
    code = "import __spark_entry__ as e; print('NAMES', *e.queries()); print('SQL', *e.oracle_sql())"
    return subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def test_entry_works_without_the_subpackage(tmp_path):
    whole = _names(ROOT)
    shutil.copytree(f"{ROOT}/statsheet", tmp_path / "statsheet", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    bare = _names(tmp_path)
    assert whole.returncode == bare.returncode == 0, bare.stderr
    mine = {x for x in whole.stdout.split() if not x.startswith("op") and x != "pipeline"}
    assert set(bare.stdout.split()) == mine


def test_other_import_errors_are_not_hidden(tmp_path):
    shutil.copytree(f"{ROOT}/statsheet", tmp_path / "statsheet", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_missing\n")
    broken = _names(tmp_path)
    assert broken.returncode and "a_module_that_is_missing" in broken.stderr
