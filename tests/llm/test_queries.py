"""Registered queries: SQL oracles, and that nothing else depends on this folder."""

import os
import subprocess
import sys

import pytest

from oracle_compare import compare, duck

import __spark_entry__ as entry
from daybook.llm.queries import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, name):
    info = compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLE[name])
    assert info["match"], info


def test_rest_works_without_this_folder(tmp_path):
    """The driver takes the folders and the pipeline away."""
    for f in os.listdir(ROOT):
        if f in ("daybook", "__spark_entry__.py"):
            os.symlink(os.path.join(ROOT, f), tmp_path / f) if f != "daybook" else os.mkdir(tmp_path / f)
    for f in os.listdir(os.path.join(ROOT, "daybook")):
        if f not in ("llm", "__pycache__"):
            os.symlink(os.path.join(ROOT, "daybook", f), tmp_path / "daybook" / f)
    code = ("import importlib.util as u; s = u.spec_from_file_location('e', '__spark_entry__.py'); m = u.module_from_spec(s);"
            "import sys; sys.path.insert(0, '.'); m.__file__ = s.origin; s.loader.exec_module(m);"
            "assert len(m.queries()) >= 29 and not [q for q in m.queries() if q.startswith('op1_')]; m.oracle_sql()")
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
