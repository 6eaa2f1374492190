"""The library stands without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("left_out", [["hiremill/llm", "tests/llm"], ["hiremill/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_imports_without_the_corpus_folders(tmp_path, left_out):
    copy = tmp_path / "copy"
    gone = {os.path.join(ROOT, x) for x in left_out}

    def skip(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or os.path.join(folder, n) in gone]

    shutil.copytree(ROOT, copy, ignore=skip)
    code = "import __spark_entry__ as e, bench, tests.check_oracles; q = e.queries(); print(len(q), 'pipeline' in q, any(k.startswith('op') for k in q), set(e.oracle_sql()) <= set(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    n, pipeline, numbered, oracles = done.stdout.split()
    assert int(n) > 80 and (pipeline, oracles) == ("False", "True")
    assert numbered == "False"
