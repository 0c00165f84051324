import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_without_the_subpackage(tmp_path):
    shutil.copytree(REPO, tmp_path / "r", ignore=lambda d, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__", "spark-warehouse")])
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q); print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", capture_output=True, text=True, env=os.environ | {"PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
