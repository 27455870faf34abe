"""What tasks leave behind in the Python workers that run them."""

import re
import subprocess
import sys
from pathlib import Path

# Worker memory is that of a process, so the test has one of its own.
TASK = """
import sys
import numpy as np
import pyarrow as pa
from burstline.llm import storage

def kept():
    return int(open("/proc/self/statm").read().split()[1]) * 4 >> 10

def run(batches):
    for batch in batches:
        # 64 KB each, below what is mapped alone, and between them what a worker goes on to hold.
        parts = [(np.ones(8_000), held.append(bytes(1_000))) for _ in range(3_000)]
        yield batch
        del parts

held = []
task = storage.lean(run) if sys.argv[1] == "lean" else run
before = kept()
rows = pa.RecordBatch.from_arrays([pa.array([1])], ["x"])
ended = []
for out in task(iter([rows, rows])):
    ended.append(out.num_rows)
print(kept() - before, ended)
"""


def grown(kind):
    root = Path(__file__).parents[2]
    found = subprocess.run(
        [sys.executable, "-c", TASK, kind], cwd=root, capture_output=True, text=True, check=True
    )
    mb, ended = re.match(r"(-?\d+) (.*)", found.stdout).groups()
    assert ended == "[1, 1]"
    return int(mb)


def test_a_task_gives_unused_memory_back():
    assert grown("plain") > 150 > 75 > grown("lean")
