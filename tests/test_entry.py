"""The entry without the packages that only the text operators need."""

import subprocess
import sys
from pathlib import Path

import registry

ROOT = Path(__file__).resolve().parents[1]
registry.load_all()


def test_a_missing_package_leaves_the_other_queries():
    code = (
        "import sys; sys.modules['xxhash'] = sys.modules['pyarrow'] = None\n"
        "import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op1_') for q in e.queries()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == [str(len(registry.QUERIES)), "False"], done.stderr[-400:]
