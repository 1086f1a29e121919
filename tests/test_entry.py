"""The entry point without the corpus operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["regex", "tokenizers", "public_tokenizers", "salesflow.llm", "corpus_pipeline"])
def test_the_corpus_part_is_optional(missing):
    """Without a library that only the corpus operators need, or without them, all other queries are there."""
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; " \
           "print(sum(q.startswith('op') or q == 'pipeline' for q in e.queries()), len(e.queries()) > 70, set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["0", "True", "True"] and "without the corpus queries" in done.stderr
