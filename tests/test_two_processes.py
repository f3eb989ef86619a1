"""Tables, registry and earlier months must be there for the next process."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEAD = """
import sys
from pyspark.sql import SparkSession
from monthclose.operators.registry import LoadRegistry
from monthclose.operators.store import MonthStore
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
root = sys.argv[1]
store = MonthStore(spark, root, "202601")
rows = lambda *r: spark.createDataFrame(r, "m string, v double")
"""
FIRST = HEAD + """
MonthStore(spark, root, "202512").replace("t", rows(("202512", 7.0)))
store.load_month("t", rows(("202601", 1.0), ("202512", 2.0)), "m")
store.replace("whole", rows(("x", 5.0)))
LoadRegistry(store).record("t", "f.dat", 2)
"""
SECOND = HEAD + """
store.load_month("t", rows(("202601", 3.0)), "m")
store.append("whole", rows(("y", 6.0)))
assert store.attach({"LM": "202512"}) == ["LM"]
print("FOUND", sorted(tuple(r) for r in store.table("t").collect()),
      sorted(tuple(r) for r in store.table("whole").collect()),
      LoadRegistry(store).loaded_rows("t", "f.dat"), [tuple(r) for r in store.query("select v from LM.t").collect()])
"""
THIRD = HEAD + """
print("FOUND", sorted(tuple(r) for r in store.table("t").collect()))
"""


def run(code, folder, tmp_path):
    env = {**os.environ, "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", code, folder], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return [line for line in done.stdout.splitlines() if line.startswith("FOUND")]


def test_the_next_process_finds_everything(tmp_path):
    folder = str(tmp_path / "root")
    run(FIRST, folder, tmp_path)
    assert run(SECOND, folder, tmp_path) == [
        "FOUND [('202512', 2.0), ('202601', 3.0)] [('x', 5.0), ('y', 6.0)] 2 [(7.0,)]"]
    assert run(THIRD, folder, tmp_path) == ["FOUND [('202512', 2.0), ('202601', 3.0)]"]
