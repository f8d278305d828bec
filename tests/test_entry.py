"""The registered queries without the text operators."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("also", [(), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_text_folders(tmp_path, also):
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json", "*.md", *also)
    copy = shutil.copytree(REPO, tmp_path / "copy", ignore=skipped)
    code = (
        "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql();"
        "assert not [n for n in q if n.startswith('op') or n == 'pipeline'] and set(s) == set(q);"
        "print(len(q))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 78
