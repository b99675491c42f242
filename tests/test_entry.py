"""The driver's entry loads the library's own queries on any machine."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["quire.llm", "corpus_pipeline", "public_tokenizers"])
def test_queries_load_without_optional_modules(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as E
from quire.plans.registry import all_oracles, all_queries
q, o = E.queries(), E.oracle_sql()
assert set(all_queries()) <= set(q) and set(all_oracles()) <= set(o)
assert "pipeline" not in q and set(o) <= set(q)
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
