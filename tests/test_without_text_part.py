"""The driver may take the text operators away: everything else must still load."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LOAD = "import __spark_entry__ as e; n = e.queries(); print(len(n), sum(k.startswith('op') and k[2].isdigit() for k in n), 'pipeline' in n)"


@pytest.mark.parametrize("gone", [["tillstream/llm"], ["tillstream/llm", "corpus_pipeline.py"]])
def test_loads_without_the_text_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *(Path(g).name for g in gone)))
    found = subprocess.run([sys.executable, "-c", LOAD], cwd=copy, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    total, operators, pipeline = found.stdout.split()
    assert int(total) > 130 and operators == "0" and pipeline == "False"
