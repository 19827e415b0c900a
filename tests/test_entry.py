"""The driver's entry imports whatever is missing beside it."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

RUN = """
import builtins, sys
sys.path.insert(0, {root!r})
blocked, real, opened = {blocked!r}, builtins.__import__, []

def guarded(name, *rest):
    if blocked and name.split(".")[0] == blocked:
        raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
    return real(name, *rest)

import pyspark.sql
builtins.__import__ = guarded
sys.addaudithook(lambda event, args: opened.append(str(args[0])) if event == "open" else None)
import __spark_entry__ as entry
assert not [p for p in opened if p.endswith(".jar")], opened
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("blocked", ["", "xxhash", "public_tokenizers", "numpy_of_nobody"])
def test_entry_imports(blocked):
    code = RUN.format(root=str(ROOT), blocked=blocked)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/", timeout=120)
    assert done.returncode == 0, done.stderr
    queries, oracles = map(int, done.stdout.split())
    assert queries >= oracles >= 74
