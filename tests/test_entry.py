"""The entry loads the base queries whatever is missing of the corpus part."""

import os
import subprocess
import sys

from tests.conftest import ROOT

PROBE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {blocked!r}:
            raise ImportError(name)
sys.meta_path.insert(0, Missing())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
print(len(e.queries()), any(q.startswith("op") and q[2].isdigit() for q in e.queries()),
      "pipeline" in e.queries(), set(e.oracle_sql()) <= set(e.queries()))
"""


def names_without(*blocked):
    out = subprocess.run([sys.executable, "-c", PROBE.format(blocked=set(blocked), root=ROOT)],
                         cwd="/tmp", capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return out.stdout.split()[-4:]


def test_base_queries_without_the_corpus_part():
    base = len(__import__("tessera.catalog", fromlist=["x"]).QUERIES)
    assert names_without("tessera.llm") == [str(base), "False", "False", "True"]
    assert names_without("xxhash") == [str(base), "False", "False", "True"]
    if os.path.exists(os.path.join(ROOT, "tessera", "llm")):
        with_llm = names_without("corpus_pipeline")
        assert int(with_llm[0]) > base and with_llm[1:] == ["True", "False", "True"]
