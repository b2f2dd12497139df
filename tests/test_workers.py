import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from caselume.session import local_session
from caselume.operators import knn
spark = local_session(2)
df = spark.range(30).selectExpr("id", "cast(id * id as double) as v")
for plan in ({}, {"broadcast_spots": 0, "block_rows": 8}):
    assert knn.nearest_neighbors(df, "id", ["v"], 2, **plan).count() == 30
print("fine")
"""


def test_python_tasks_run_from_any_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, repo], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert "fine" in done.stdout, done.stderr[-2000:]
