"""The driver's entry point works, with and without the training-data subpackage."""

import os
import subprocess
import sys

import pytest

DATA = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_query_of_the_engine_is_registered():
    import __spark_entry__ as e
    from docloom import queries

    assert queries.QUERIES.keys() <= e.queries().keys() and e.oracle_sql().keys() <= e.queries().keys()


def test_nothing_else_needs_the_training_data_subpackage(tmp_path):
    """A copy of the library without it still registers and plans."""
    import shutil

    shutil.copytree(f"{ROOT}/docloom", f"{tmp_path}/docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') or n == 'pipeline' for n in q), q; import sys; assert not any('llm' in m for m in sys.modules)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables here")
def test_flagship(spark):
    import __spark_entry__ as e

    rows = e.entry(spark).collect()
    prices = [r["o_totalprice"] for r in rows]
    assert len(rows) == 10 and prices == sorted(prices, reverse=True) and all(r["o_orderstatus"] == "F" and r["o_totalprice"] > 100000 for r in rows)
