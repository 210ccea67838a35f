from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from factprep.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            # A zone with clock changes, so that nothing may lean on UTC.
            "spark.sql.session.timeZone": "America/New_York",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def trips(tmp_path):
    from trips import write_trips

    return write_trips(tmp_path / "input")
