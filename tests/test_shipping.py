"""Executors run the package's Python functions without having the package."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
PROGRAM = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as registered
from factprep.session import build_session
spark = build_session("shipping", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
for name in ("file_inventory", "input_manifest", "clean_in_arrow", "speed_scalar_udf", "speed_arrow_udf"):
    assert registered.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("shipped")
"""


def test_functions_travel_by_value(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM], cwd=tmp_path, capture_output=True, text=True, timeout=300, check=False
    )
    assert "shipped" in done.stdout, done.stderr[-2000:]
