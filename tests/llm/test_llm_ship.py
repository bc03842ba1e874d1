"""Python workers that cannot import the package."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__
from swapbook.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2)
spark.sparkContext.setLogLevel("ERROR")
try:
    spark.range(1).mapInPandas(lambda rows: __import__("swapbook") and rows, "id long").collect()
except Exception as missing:
    assert "No module named 'swapbook'" in str(missing)
else:
    raise AssertionError("workers see the package, so this shows nothing")
for name in {names!r}:
    print(name, __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001").count(), flush=True)
"""
NAMES = [
    "op4_nearest_neighbours", "op5_language_id", "op7_bpe", "op8_toxicity", "op10_chat_formatting",
    "op11_hard_negatives", "op12_whitening", "op13_token_files",
]


def test_from_another_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    folder = tempfile.mkdtemp(prefix="run-")
    script = os.path.join(folder, "foreign.py")
    with open(script, "w") as out:
        out.write(SCRIPT.format(root=ROOT, names=NAMES))
    done = subprocess.run([sys.executable, script], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == NAMES
