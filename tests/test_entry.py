"""The driver's entry without the training-data operators, or without what only they need."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as driver
print(len(driver.queries()), sum(q.startswith("op") or q == "pipeline" for q in driver.queries()))
"""


def started(name: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("name", ["tapflow.llm", "corpus_pipeline", "public_tokenizers", "xxhash", "tokenizers"])
def test_core_queries_stay(name):
    out = started(name)
    assert out.returncode == 0, out.stderr
    core, more = map(int, out.stdout.split())
    assert core > 100 and more == 0


@pytest.mark.parametrize("name", ["tapflow.operators.od", "registry"])
def test_a_missing_part_of_the_library_is_an_error(name):
    assert started(name).returncode != 0
