"""Exact comparison of two datasets and audit of a finished one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factprep.contract import FactContract
from factprep.functions.cleaning import is_finite, quoted
from factprep.functions.features import duration_seconds, start_hour, with_speed
from factprep.functions.keys import bucket_id, exact_text

def tally(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Each distinct row with its number of copies on either side: ``lhs`` and ``rhs``.

    One aggregation; copies are counted before the shuffle. Grouping merges -0.0
    with 0.0, so every double comes with a flag for a negative zero.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    inexact = [c for c in columns if isinstance(types[c], (T.DoubleType, T.FloatType))]
    flags = {c: quoted(f"__negative_{c}") for c in inexact}

    def side(df: DataFrame, counts: str) -> DataFrame:
        negative = [
            f"CASE WHEN {quoted(c)} = 0 THEN {exact_text(quoted(c))} = '-0.0' ELSE false END AS {f}"
            for c, f in flags.items()
        ]
        return df.selectExpr(*map(quoted, columns), *negative, *counts.split(", "))

    both = side(left, "1 AS l, 0 AS r").unionByName(side(right, "0 AS l, 1 AS r"))
    counted = both.groupBy(*columns, *flags.values()).agg(F.sum("l").alias("lhs"), F.sum("r").alias("rhs"))
    restored = [
        f"IF({flags[c]}, CAST('-0.0' AS {types[c].simpleString()}), {quoted(c)}) AS {quoted(c)}"
        if c in inexact
        else quoted(c)
        for c in columns
    ]
    return counted.selectExpr(*restored, "lhs", "rhs")


def exact_form(df: DataFrame, columns: list[str]) -> list[str]:
    """Expressions whose hash tells any two unlike rows apart: hashing skips nulls and merges -0.0 with 0.0."""
    types = {f.name: f.dataType for f in df.schema.fields}
    marks = []
    for column in columns:
        negative = ""
        if isinstance(types[column], (T.DoubleType, T.FloatType)):
            negative = f" WHEN {quoted(column)} = 0 AND {exact_text(quoted(column))} = '-0.0' THEN '-'"
        marks.append(f"CASE WHEN {quoted(column)} IS NULL THEN '0'{negative} ELSE '1' END")
    return [f"concat({', '.join(marks)})", *map(quoted, columns)]


def bucket_sums(df: DataFrame, columns: list[str], bucket: str = "bucket") -> DataFrame:
    """``bucket``, ``row_count`` and two sums that depend on the multiset of the bucket's rows and not on their order.

    Each is the exact sum of an independently seeded 64-bit hash of every row. Rows are not shuffled, only sums.
    """
    form = ", ".join(exact_form(df, columns))
    hashed = df.selectExpr(
        f"{quoted(bucket)} AS bucket", f"xxhash64({form}) AS h1", f"xxhash64('second', {form}) AS h2"
    )
    sums = [F.sum(F.col(h).cast("decimal(38,0)")).alias(s) for h, s in (("h1", "sum1"), ("h2", "sum2"))]
    return hashed.groupBy("bucket").agg(F.count("*").alias("row_count"), *sums)


def bucket_parity(left: DataFrame, right: DataFrame, columns: list[str], bucket: str = "bucket") -> DataFrame:
    """``bucket``, ``left_rows``, ``right_rows`` and whether both sides hold the same rows as often, for every bucket.

    Unlike buckets agree by chance in one of about 2^128 cases.
    """
    one, other = bucket_sums(left, columns, bucket).alias("l"), bucket_sums(right, columns, bucket).alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("row_count", "sum1", "sum2")]
    return one.join(other, F.col("l.bucket").eqNullSafe(F.col("r.bucket")), "full").select(
        F.coalesce("l.bucket", "r.bucket").alias("bucket"),
        F.coalesce("l.row_count", F.lit(0)).alias("left_rows"),
        F.coalesce("r.row_count", F.lit(0)).alias("right_rows"),
        (same[0] & same[1] & same[2]).alias("equal"),
    )


def repeated_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that occur more than once: only hashes are shuffled, and rows of those that repeat."""
    form = ", ".join(exact_form(df, columns))
    key = f"xxhash64({form})"
    often = df.selectExpr(f"{key} AS __key").groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1")
    suspects = df.selectExpr("*", f"{key} AS __key").join(often.select("__key"), "__key", "left_semi").drop("__key")
    return tally(suspects, suspects.limit(0), columns).where("lhs > 1")


def require_parity_by_bucket(
    left: DataFrame, right: DataFrame, contract: FactContract, bucket: str = "bucket"
) -> dict[str, int]:
    """As ``require_parity``, for outputs laid out by bucket: equal ones compare without a shuffle of rows.

    Only the first bucket that differs is tallied row by row, and reading it prunes the others.
    """
    columns = contract.output_columns
    report = bucket_parity(left, right, columns, bucket)
    worst = report.where("NOT equal").orderBy("bucket").take(1)
    if worst:
        here = F.col(bucket).eqNullSafe(F.lit(worst[0].bucket))
        row = multiset_diff(left.where(here), right.where(here), columns).take(1)[0]
        raise ValueError(
            f"Output mismatch in bucket {worst[0].bucket}: counts=({row.lhs}, {row.rhs}), row={row.asDict()}"
        )
    # The sides are equal, so what one repeats the other does.
    again = repeated_rows(left, columns).take(1)
    if again:
        raise ValueError(f"Output duplicate: counts=({again[0].lhs}, {again[0].lhs}), row={again[0].asDict()}")
    rows = report.agg(F.sum("left_rows")).first()[0] or 0
    return {"left_rows": rows, "right_rows": rows}


def multiset_diff(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that the two sides hold in different numbers."""
    return tally(left, right, columns).where(F.col("lhs") != F.col("rhs"))


def duplicates(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that one side holds more than once, also when both do."""
    return tally(left, right, columns).where((F.col("lhs") > 1) | (F.col("rhs") > 1))


def audit_rows(df: DataFrame, contract: FactContract, buckets: int | None = None, bucket: str = "bucket") -> DataFrame:
    """Violations per rule of a finished dataset: ``rule``, ``violations``; one pass.

    Durations, hours, speeds and, with ``buckets``, bucket numbers are computed
    anew and compared with the stored ones.
    """
    start, end = quoted(contract.start), quoted(contract.end)
    anew = df.selectExpr("*", f"{duration_seconds(start, end)} AS __duration", f"{start_hour(start)} AS __hour")
    # Without a duration there is no speed, and none can be right.
    anew = anew.selectExpr("*", "nullif(__duration, 0D) AS __divisor")
    checked = with_speed(anew, contract.distance, "__divisor", "__speed")
    broken = {
        "value_missing": " OR ".join(f"{quoted(c)} IS NULL" for c in contract.output_columns),
        "float_not_finite": " OR ".join(f"NOT ({is_finite(quoted(c))})" for c in contract.floats),
        "not_positive": f"__duration <= 0D OR {quoted(contract.distance)} <= 0D",
        "duration_differs": f"NOT ({quoted(contract.duration)} <=> __duration)",
        "hour_differs": f"NOT ({quoted(contract.hour)} <=> __hour)",
        "speed_differs": f"NOT ({quoted(contract.speed)} <=> __speed)",
    }
    if buckets is not None:
        broken["wrong_bucket"] = f"NOT ({quoted(bucket)} <=> {bucket_id(contract.columns, buckets)})"
    counts = ", ".join(f"struct('{rule}' AS rule, count_if({p}) AS violations)" for rule, p in broken.items())
    return checked.agg(F.expr(f"array({counts})").alias("counts")).selectExpr("inline(counts)")


def check_schema(df: DataFrame, contract: FactContract, *partition_columns: str) -> None:
    """Raise unless the columns and types are exactly the output ones, in order."""
    found = [(f.name, f.dataType) for f in df.schema.fields if f.name not in partition_columns]
    expected = [(f.name, f.dataType) for f in contract.output_schema().fields]
    if found != expected:
        raise ValueError(f"Unexpected output schema: {found}")


def require_parity(left: DataFrame, right: DataFrame, contract: FactContract) -> dict[str, int]:
    """Raise on the first difference or repeated row; otherwise return the row totals."""
    columns = contract.output_columns
    counted = tally(left, right, columns)
    differs = F.col("lhs") != F.col("rhs")
    worst = (
        counted.where(differs | (F.col("lhs") > 1) | (F.col("rhs") > 1))
        .orderBy(differs.desc())
        .take(1)
    )
    if worst:
        row = worst[0]
        kind = "mismatch" if row.lhs != row.rhs else "duplicate"
        raise ValueError(f"Output {kind}: counts=({row.lhs}, {row.rhs}), row={row.asDict()}")
    # No row is repeated and none differs, so one count serves both sides.
    rows = left.count()
    return {"left_rows": rows, "right_rows": rows}


def require_clean_audit(df: DataFrame, contract: FactContract, buckets: int | None = None) -> None:
    broken = audit_rows(df, contract, buckets).where("violations > 0").orderBy("rule").collect()
    if broken:
        raise ValueError("Audit failed: " + ", ".join(f"{r.rule}={r.violations}" for r in broken))
