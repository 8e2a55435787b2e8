"""The core loads whatever optional package is missing."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
CODE = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
names = entry.queries()
assert "order_mart" in names and not any(n.startswith("op") and n[2].isdigit() for n in names), names
assert "pipeline" not in names and set(entry.oracle_sql()) <= set(names)
"""


def test_core_without_the_packages_of_the_text_operators():
    for name in ("xxhash", "parcelight.llm"):
        run = subprocess.run([sys.executable, "-c", CODE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=100)
        assert run.returncode == 0, run.stderr
