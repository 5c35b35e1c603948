"""The library without its training-data subpackage: the entry module imports, lists and runs the other queries."""
import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
import __spark_entry__ as e
names = e.queries()
assert len(names) > 150 and set(e.oracle_sql()) <= set(names)
assert not [n for n in names if n.startswith("op") and n[2].isdigit()] and "pipeline" not in names, sorted(names)
import lakeops.plans.registry
assert not [m for m in sys.modules if m.startswith("lakeops.llm.")]
print(len(names))
"""


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",), ("__pycache__",)])
def test_entry_without_the_subpackage(tmp_path, left):
    """Also where only one of the two is gone: the pipeline's file, or all of the folder but compiled files."""
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *({"corpus_pipeline.py"} - set(left))))
    if "__pycache__" in left:
        (copy / "lakeops/llm/__pycache__").mkdir(parents=True)
    got = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ""})
    assert got.returncode == 0, got.stderr
