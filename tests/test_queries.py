"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import connect, differences

import __spark_entry__ as registered

ROOT = "/root/testdata/sf0.001"
SQL = registered.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_matches_sql(spark, connection, name):
    frame = registered.queries()[name](spark, ROOT)
    if name in SQL:
        assert differences(frame, connection, SQL[name]) == []
    else:
        assert frame.count() > 0


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0


def test_sql_names_registered_queries():
    assert set(SQL) <= set(registered.queries())


def test_manifest_checksums(spark):
    import hashlib
    from pathlib import Path

    rows = registered.queries()["input_manifest"](spark, ROOT).collect()
    expected = {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(ROOT).glob("*.parquet")}
    assert {r.filename: r.sha256 for r in rows} == expected
    assert {r.filename: r.bytes for r in rows} == {p.name: p.stat().st_size for p in Path(ROOT).glob("*.parquet")}
