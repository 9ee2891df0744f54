"""The entry module stands without the training-data operators: also when their
folder is left behind without code, or a library of theirs is missing."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; from ledgerlake import queries as q; assert set(e.queries()) == set(q.queries()), set(e.queries()) ^ set(q.queries()); assert set(e.oracle_sql()) == set(e.queries())"


@pytest.mark.parametrize("left", ["gone", "cache_only", "broken"])
def test_core_queries_without_the_subpackage(tmp_dir, left):
    home = f"{tmp_dir}/copy"
    os.makedirs(f"{home}/ledgerlake")
    for name in os.listdir(f"{ROOT}/ledgerlake"):
        if name not in ("llm", "__pycache__"):
            full = f"{ROOT}/ledgerlake/{name}"
            (shutil.copytree if os.path.isdir(full) else shutil.copy)(full, f"{home}/ledgerlake/{name}")
    shutil.copy(f"{ROOT}/__spark_entry__.py", home)
    if left != "gone":
        os.makedirs(f"{home}/ledgerlake/llm/__pycache__")
    if left == "broken":
        for name, text in (("ledgerlake/llm/__init__", ""), ("ledgerlake/llm/queries", "import no_such_library\n"), ("corpus_pipeline", "from ledgerlake.llm import queries\n")):
            with open(f"{home}/{name}.py", "w") as f:
                f.write(text)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=home, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
