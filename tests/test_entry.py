"""The entry module without the parts that may be missing."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as spark_entry
from msgstream.plans import registry

ROOT = os.path.dirname(os.path.abspath(spark_entry.__file__))
LISTED = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def _listed(folder):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", LISTED], cwd=folder, capture_output=True, text=True, check=True)
    return [line.split() for line in done.stdout.splitlines()]


@pytest.mark.parametrize("missing", [["msgstream/llm"], ["msgstream/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_core_needs_no_training_data_queries(tmp_path, missing):
    def left_out(folder, names):
        inside = os.path.relpath(folder, ROOT)
        return [n for n in names if os.path.normpath(os.path.join(inside, n)) in missing or n in ("__pycache__", ".git", "tests")]

    shutil.copytree(ROOT, tmp_path / "repo", ignore=left_out)
    queries, oracles = _listed(tmp_path / "repo")
    if "msgstream/llm" in missing:
        assert queries == sorted(registry.QUERIES) and oracles == sorted(registry.ORACLES)
    assert "pipeline" not in queries and registry.QUERIES.keys() <= set(queries)


def test_core_needs_no_module_of_the_training_data_queries(tmp_path):
    """A module that only they import is missing."""
    blocked = "import sys; sys.modules['public_tokenizers'] = None; " + LISTED
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", blocked], cwd=ROOT, capture_output=True, text=True, check=True)
    assert done.stdout.splitlines()[0].split() == sorted(registry.QUERIES)
