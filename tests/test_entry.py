"""The entry works without the training-data part, or without what it needs."""

import subprocess
import sys

import pytest

HIDE = """
import builtins, sys
real = builtins.__import__
def hidden(name, *a, **k):
    if name.split(".")[0] == {name!r} or name == {name!r}:
        raise ImportError(name)
    return real(name, *a, **k)
builtins.__import__ = hidden
sys.path.insert(0, "/root/repo" if False else {root!r})
import __spark_entry__ as e
from costbook.plans import registry
assert set(e.queries()) == set(registry.QUERIES), "only the other queries"
assert set(e.oracle_sql()) == set(registry.QUERIES)
"""


@pytest.mark.parametrize("name", ["xxhash", "public_tokenizers", "corpus_pipeline"])
def test_the_other_queries_are_listed(name):
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", HIDE.format(name=name, root=root)], check=True, timeout=300)
