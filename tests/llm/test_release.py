"""What a task has freed goes back to the system when it ends."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CHILD = """
import re, sys
from cardmarts.llm.common import releasing

def mb():
    return int(re.search(r"\\nRssAnon:\\s+(\\d+)", open("/proc/self/status").read())[1]) / 1024

kept = []

def task(batches):
    for batch in batches:
        held = [b"x" * 2_000 + bytes([k % 256]) for k in range(100_000)]  # 200 MB in small parts
        kept.append(held[-1])  # at the heap's end, so that the C library alone gives nothing back
        yield batch

before = mb()
assert list((releasing(task) if sys.argv[1] == "released" else task)([1])) == [1]
print(mb() - before)
"""


def grown(how: str) -> float:
    done = subprocess.run([sys.executable, "-c", CHILD, how], capture_output=True, text=True, timeout=120, cwd=REPO)
    assert done.returncode == 0, done.stderr
    return float(done.stdout)


def test_freed_memory_goes_back_to_the_system():
    assert grown("plain") > 150  # else this test shows nothing
    assert grown("released") < 60
