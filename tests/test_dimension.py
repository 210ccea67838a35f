import pytest

from factprep.operators.quality import dimension_violations, require_dimension
from factprep.sources.dimension import read_dimension

HEADER = "LocationID,Borough,Zone,service_zone\n"


def _read(spark, tmp_path, text, name="zones.csv"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return read_dimension(spark, str(path))


def test_byte_order_mark_and_quotes(spark, tmp_path):
    dim = _read(spark, tmp_path, "﻿" + HEADER + '1,Queens,"Zone, ""A""",x\n2,Bronx,"Two\nlines",x\n')
    assert sorted(dim.collect()) == [(1, "Queens", 'Zone, "A"'), (2, "Bronx", "Two\nlines")]
    assert require_dimension(dim) == 2 * 64 + len("Queens" 'Zone, "A"' "Bronx" "Two\nlines")


def test_columns_are_found_by_name(spark, tmp_path):
    assert _read(spark, tmp_path, "Zone,LocationID,Borough\nA,7,Q\n").collect() == [(7, "Q", "A")]


def test_missing_column(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks columns"):
        _read(spark, tmp_path, "LocationID,Borough\n1,Q\n")


@pytest.mark.parametrize(
    ("rows", "rule"),
    [
        ("1,Queens,A,x\n1,Queens,B,x\n", "id_repeated"),
        ("1,,A,x\n", "name_missing"),
        ("1,Queens,,x\n", "name_missing"),
        ("one,Queens,A,x\n", "id_missing"),
    ],
)
def test_broken_rules(spark, tmp_path, rows, rule):
    dim = _read(spark, tmp_path, HEADER + rows)
    assert [r.rule for r in dimension_violations(dim).collect()] == [rule]
    with pytest.raises(ValueError, match=rule):
        require_dimension(dim)


def test_empty(spark, tmp_path):
    with pytest.raises(ValueError, match="empty"):
        require_dimension(_read(spark, tmp_path, HEADER))
