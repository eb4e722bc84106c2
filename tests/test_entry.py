"""Driver contract: entry smoke run and query/oracle registry consistency."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["tradeid", "symbol", "price", "tradername", "trade_datetime"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
    assert len(qs) >= 55


def test_entry_without_the_optional_subpackage(tmp_path):
    """Deleting the training-data folders leaves the rest importable."""
    import os
    import shutil
    import subprocess
    import sys

    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{top}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{top}/__spark_entry__.py", tmp_path)
    code = ("import __spark_entry__ as E; q = E.queries(); assert len(q) >= 55 and set(E.oracle_sql()) <= set(q); "
            "assert not any(k.startswith('op') and k[2:3].isdigit() or k == 'pipeline' for k in q)")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    (tmp_path / "tidemark" / "llm").mkdir()  # an emptied folder
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
