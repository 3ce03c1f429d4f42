"""The library without its optional folders."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import __spark_entry__ as e
assert e.llm_queries is None and e.corpus_pipeline is None
names = e.queries()
assert "rfm" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
assert set(e.oracle_sql()) <= set(names)
print(len(names))
"""


def test_entry_without_the_training_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    for keep_pipeline in (False, True):
        if keep_pipeline:  # it can be found, but not what it imports
            (copy / "corpus_pipeline.py").write_text((ROOT / "corpus_pipeline.py").read_text() if (ROOT / "corpus_pipeline.py").exists() else "import tidegrain.llm.simhash")
        run = subprocess.run([sys.executable, "-c", CODE], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
        assert run.returncode == 0, run.stderr
        assert int(run.stdout.split()[-1]) > 200
