"""The entry module stands without the training-data subpackage."""

import subprocess
import sys

import pytest

ROOT = __file__.rsplit("/", 2)[0]


@pytest.mark.parametrize("gone", ["millrace.llm", "corpus_pipeline", "tiktoken"])
def test_core_queries_remain(gone):
    # None in sys.modules makes an import of that name fail.
    code = f"import sys; sys.modules[{gone!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == int(out[1]) >= 68 and out[2] == "False"
