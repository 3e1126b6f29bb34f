"""Registered queries against their SQL, and the entry's guard."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from chamberlens.llm.oracles import LLM_ORACLES
from chamberlens.llm.queries import LLM_QUERIES
from compare import check

REPO = os.path.dirname(os.path.abspath(entry.__file__))


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_matches_sql_on_the_larger_tables(spark, medium, name):
    assert check(spark, medium, LLM_QUERIES[name], LLM_ORACLES[name]) is None


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in LLM_QUERIES]
    assert names == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(LLM_QUERIES) <= set(entry.queries())


def test_the_rest_works_without_the_subpackage(tmp_path):
    for part in ("chamberlens", "__spark_entry__.py"):
        source = os.path.join(REPO, part)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / part)
    code = "import __spark_entry__ as e; assert 'op1_language_id' not in e.queries(); assert len(e.queries()) > 50"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
