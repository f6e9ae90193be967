"""The entry offers what is there, with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), set(o) <= set(q), 'pipeline' in q, sum(k[:2] == 'op' and k[2].isdigit() for k in q))"


@pytest.mark.parametrize("gone", [(), ("quirework/llm", "tests/llm"), ("quirework/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry(tmp_path, gone):
    here = tmp_path / "repo"
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for name in gone:
        if (here / name).is_dir():
            shutil.rmtree(here / name)
        else:
            (here / name).unlink(missing_ok=True)
    whole = (here / "quirework/llm").is_dir() and (here / "corpus_pipeline.py").exists()
    said = subprocess.run([sys.executable, "-c", SAY], cwd=here, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 50 and said[1:] == ["True", str(whole), "10" if (here / "quirework/llm").is_dir() else "0"]
