"""Derived columns: exact durations, hours and speeds rounded as Python rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factprep.contract import FactContract
from factprep.functions.cleaning import quoted

PARTS = ("DAY", "HOUR", "MINUTE", "SECOND")


def micros_between(start: str, end: str) -> str:
    """Whole microseconds between two zone-free timestamps.

    Takes the parts of the interval between them; ``unix_micros`` and
    ``timestampdiff`` would pass through the session time zone and be wrong
    around clock changes. A second's six decimals survive as a double.
    """
    days, hours, minutes, seconds = (f"extract({part} FROM ({end} - {start}))" for part in PARTS)
    whole = f"(({days} * 24L + {hours}) * 60L + {minutes}) * 60000000L"
    return f"({whole} + CAST(rint(CAST({seconds} AS DOUBLE) * 1000000D) AS BIGINT))"


def duration_seconds(start: str, end: str) -> str:
    return f"CAST({micros_between(start, end)} AS DOUBLE) / 1000000D"


def start_hour(start: str) -> str:
    return f"CAST(hour({start}) AS BIGINT)"


def with_rounded(df: DataFrame, name: str, value: str) -> DataFrame:
    """Add ``name`` = ``value`` (not negative) rounded to six decimals as Python's ``round`` does.

    Python rounds the exact binary value half-even. The product with 1e6 is
    formed together with its exact rounding error (Dekker's splitting, 1971),
    which decides every case that looks like a tie. From 2^33 on, neighbouring
    doubles are more than a millionth apart and the value stays as it is. The
    steps are separate projections so that each is computed once and none is
    rearranged.
    """
    keep = [quoted(c) for c in df.columns if c != name]
    split = "134217729D * __x"  # 2^27 + 1
    up = """
        CASE WHEN __p - __f > 0.5D OR (__p - __f = 0.5D AND __e > 0D) THEN 1D
             WHEN __p - __f < 0.5D OR __e < 0D THEN 0D
             ELSE pmod(__f, 2D) END"""
    return (
        df.selectExpr(*keep, f"{value} AS __x")
        .selectExpr("*", "__x * 1000000D AS __p", f"{split} - ({split} - __x) AS __h")
        .selectExpr(
            "*",
            "(__h * 1000000D - __p) + (__x - __h) * 1000000D AS __e",
            "CASE WHEN __x < 8589934592D THEN CAST(floor(__p) AS DOUBLE) END AS __f",
        )
        .selectExpr(*keep, f"CASE WHEN __x >= 8589934592D THEN __x ELSE (__f + {up}) / 1000000D END AS {quoted(name)}")
    )


def with_speed(df: DataFrame, distance: str, duration: str, name: str = "speed") -> DataFrame:
    """Distance per hour, rounded to six decimals."""
    return with_rounded(df, name, f"{quoted(distance)} * 3600D / {quoted(duration)}")


def add_features(df: DataFrame, contract: FactContract) -> DataFrame:
    """Duration, hour and speed of each row."""
    start, end = quoted(contract.start), quoted(contract.end)
    added = (contract.duration, contract.hour)
    timed = df.selectExpr(
        *[quoted(c) for c in df.columns if c not in added],
        f"{duration_seconds(start, end)} AS {quoted(contract.duration)}",
        f"{start_hour(start)} AS {quoted(contract.hour)}",
    )
    return with_speed(timed, contract.distance, contract.duration, contract.speed)


def finalize(df: DataFrame, contract: FactContract, *extra: str) -> DataFrame:
    """Output columns in their fixed order and types, then any ``extra`` ones."""
    found = {f.name: f.dataType for f in df.schema.fields}
    fixed = [
        quoted(f.name)
        if found[f.name] == f.dataType
        else f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
        for f in contract.output_schema().fields
    ]
    return df.selectExpr(*fixed, *map(quoted, extra))
