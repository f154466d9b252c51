"""The entry without what it can do without."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["rankloom.llm", "ahocorasick", "corpus_pipeline", "public_tokenizers"])
def test_core_queries_need_no_optional_module(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as e\n"
            "names = e.queries().keys() | e.oracle_sql().keys()\n"
            "assert 'rank_dir' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names)")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
