"""The library, its queries and their SQL work without the training-data subpackage, with or without the pipeline's file."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASKS = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert 'flagship' in q and set(s) <= set(q) and not any(n.startswith('op') or n == 'pipeline' for n in q); print(len(q))"


def test_without_the_subpackage(tmp_path):
    for name in ("pelagia", "__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    for rest in ("corpus_pipeline.py", ""):
        done = subprocess.run([sys.executable, "-B", "-c", ASKS], cwd=tmp_path, env=os.environ | {"PYTHONPATH": f"{tmp_path}:" + os.environ.get("PYTHONPATH", "")}, capture_output=True, text=True)
        assert done.returncode == 0 and int(done.stdout) > 70, done.stderr
        (tmp_path / (rest or "corpus_pipeline.py")).unlink(missing_ok=True)
