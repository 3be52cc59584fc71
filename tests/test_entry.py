"""The entry points without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(set(e.queries()) - set(e.oracle_sql())))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_without_the_subpackage(tmp_path, with_pipeline):
    from plantspark.plans.catalog import QUERIES

    left_out = shutil.ignore_patterns("llm", ".*", "__pycache__", *[] if with_pipeline else ["corpus_pipeline.py"])
    shutil.copytree(HERE, tmp_path / "copy", ignore=left_out)
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "[]"]
