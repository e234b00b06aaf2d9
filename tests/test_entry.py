"""The entry module works with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
from courtline.plans import catalog

ROOT = os.path.dirname(os.path.abspath(E.__file__))


def test_core_queries_without_the_subpackage(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    shutil.copytree(os.path.join(ROOT, "courtline"), os.path.join(copy, "courtline"), ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": copy}).stdout
    names = sorted(catalog.QUERIES)
    assert [line.split() for line in out.splitlines()] == [names, names]


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "courtline")):
        if "llm" not in folder.split(os.sep):
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f)) as source:
                        assert "courtline.llm" not in source.read(), f
