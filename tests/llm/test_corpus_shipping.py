"""Executors run the corpus operators without having the package."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent.parent
PROGRAM = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as registered
from factprep.session import build_session
settings = {{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": sys.argv[1], "spark.log.level": "ERROR"}}
spark = build_session("shipping", "local[4]", **settings)
for name, query in registered.queries().items():
    if name.startswith("op"):
        assert query(spark, "/root/testdata/sf0.001").count() > 0, name
print("shipped")
"""


def test_functions_travel_by_value(tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", PROGRAM, str(tmp_path / "shared")],
        cwd=tmp_path, capture_output=True, text=True, timeout=900, check=False,
    )
    assert "shipped" in done.stdout, done.stderr[-2000:]
    # The application's scratch files went with it.
    assert not list((tmp_path / "shared").glob("factprep-*"))
