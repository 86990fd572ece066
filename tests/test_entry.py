"""The registered queries with and without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_everything_else_works_without_the_text_operators(tmp_path):
    for name in ("dockside", "oracle"):
        shutil.copytree(os.path.join(ROOT, name), tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    said = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", said], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert out.stdout.split()[1:] == ["True", "False"] and int(out.stdout.split()[0]) >= 130


def test_an_error_inside_the_text_operators_is_not_swallowed(tmp_path):
    for name in ("dockside", "oracle"):
        shutil.copytree(os.path.join(ROOT, name), tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert out.returncode and "no_such_module" in out.stderr
