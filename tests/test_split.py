"""The library without its training-data part: the entry loads, lists the core queries and runs one."""

import json
import os
import shutil
import subprocess
import sys

from tastebud.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHILD = """
import json, sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
assert entry.__file__.startswith(sys.argv[1]), entry.__file__
from tastebud.session import local_session
spark = local_session(2, 2)
n = entry.queries()["find_user"](spark, "/root/testdata/sf0.001").count()
print("RESULT " + json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql()), n]))
spark.stop()
"""


def test_entry_loads_without_the_training_data_part(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "tastebud"), copy / "tastebud", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(os.path.join(ROOT, name), copy / name)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run([sys.executable, "-c", CHILD, str(copy)], capture_output=True, text=True, env=env, cwd=copy, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    queries, oracles, n = json.loads(next(x for x in done.stdout.splitlines() if x.startswith("RESULT "))[7:])
    assert set(queries) == set(QUERIES)
    assert set(oracles) <= set(queries) and n > 0
    # without the pipeline's file it loads just as well
    os.rename(copy / "corpus_pipeline.py", copy / "other.txt")
    code = "import sys; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code, str(copy)], capture_output=True, text=True, env=env, cwd=copy, timeout=300)
    assert done.returncode == 0 and int(done.stdout) == len(QUERIES)
