import os
import subprocess
import sys

import __spark_entry__ as e

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_contract(spark):
    assert set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    assert df.columns == ["doc_id", "keeper", "bytes", "tier", "evidence"] and df.count() == 11


def test_imports_without_llm(tmp_path):
    """The rest works where the llm folders and the pipeline are gone."""
    for name in os.listdir(ROOT):
        if name in ("__spark_entry__.py", "bench.py"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "tidewell")
    for name in os.listdir(f"{ROOT}/tidewell"):
        if name not in ("llm", "__pycache__"):
            os.symlink(f"{ROOT}/tidewell/{name}", tmp_path / "tidewell" / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'dup_suggestions' in q and 'pipeline' not in q and not any(x.startswith('op1') for x in q); assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}).returncode == 0
