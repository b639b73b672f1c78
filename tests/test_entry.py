"""The entry module works without the corpus part, and without what only that part needs."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("absent", ["ahocorasick", "public_tokenizers", "ledgerlens.llm"])
def test_missing_modules_leave_the_rest(absent):
    program = f"""
import sys, warnings
sys.modules[{absent!r}] = None
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
assert any("left out" in str(w.message) for w in said)
names = entry.queries()
assert "seller_features" in names and "op1_toxicity" not in names and "pipeline" not in names
assert not [n for n in entry.oracle_sql() if n.startswith("op")]
"""
    subprocess.run([sys.executable, "-c", program], cwd=REPO, check=True, timeout=120)
