"""The entry file without the parts and libraries that may be absent."""

import json
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
#: Blocks a module, imports the entry file, and prints the names of the queries.
SCRIPT = """
import json, sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as entry
assert set(entry.oracle_sql()) <= set(entry.queries())
print(json.dumps(sorted(entry.queries())))
"""


def names(*absent):
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, *absent], cwd=ROOT, capture_output=True, text=True, check=True, timeout=300
    )
    return set(json.loads(done.stdout.splitlines()[-1]))


@pytest.mark.parametrize("absent", ["zstandard", "xxhash", "millrace.llm", "corpus_pipeline"])
def test_queries_without(absent):
    everything, core = names(), names("millrace.llm", "corpus_pipeline")
    assert "cdc_merge" in core and "window_count" in core and "pipeline" not in core
    got = names(absent)
    assert core <= got <= everything and "pipeline" not in got
    if absent == "corpus_pipeline":
        # The operators do not need the pipeline.
        assert everything - got <= {"pipeline"}
