"""The entry points where the subpackage for training data, or a library it needs, is missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = """
import sys, warnings
for name in {blocked!r}:
    sys.modules[name] = None
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len(entry.queries()), set(entry.queries()) == set(entry.oracle_sql()), len([w for w in said if "left out" in str(w.message)]))
"""


@pytest.mark.parametrize(
    "blocked, warned",
    [
        (["corpus_pipeline"], 0),
        (["incident_stream.llm"], 0),
        (["ahocorasick"], 1),
        (["public_tokenizers"], 1),
        (["tiktoken", "sentencepiece"], 1),
    ],
)
def test_the_own_queries_stay(blocked, warned):
    from incident_stream.plans import catalog

    run = subprocess.run(
        [sys.executable, "-c", PROGRAM.format(blocked=blocked)],
        cwd=ROOT, capture_output=True, text=True, check=True, timeout=120,
    )
    if not os.path.isdir(os.path.join(ROOT, "incident_stream", "llm")):
        warned = 0
    assert run.stdout.split() == [str(len(catalog.registered())), "True", str(warned)]
