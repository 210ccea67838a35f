"""Coercion, validity rules and normal forms of single columns, as SQL expressions.

Every helper looks at the physical type it is given, so that a column which
already has a suitable type is used untouched and its rule can reach the
Parquet reader as a pushed filter.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Bounds of the contract.
INT32_FIRST = -2147483648
INT32_END = 2147483648
TIME_FIRST = "1678-01-01 00:00:00"
TIME_END = "2262-01-01 00:00:00"

# English months by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# Spellings of a date beside ISO: what a text begins with, and the same as year-month-day.
# Where month and day are both numbers after one another, the month comes first.
SPELLINGS = {
    "year/month/day": (r"^([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})(?![0-9])", "$1-$2-$3"),
    "month/day/year": (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})(?![0-9])", "$3-$1-$2"),
    "compact": (r"^([0-9]{4})([0-9]{2})([0-9]{2})(?:T?([0-9]{2})([0-9]{2})([0-9]{2})$|(?![0-9]))", "$1-$2-$3 $4:$5:$6"),
    "day month year": (r"^([0-9]{1,2})[ -]([A-Za-z]{3})[a-z]*[ -]([0-9]{4})(?![0-9])", "$3-$2-$1"),
    "month day, year": (r"^([A-Za-z]{3})[a-z]* ([0-9]{1,2}),? ([0-9]{4})(?![0-9])", "$3-$1-$2"),
}
ISO = r"^([0-9]{4,6}-|[0-9]{4}$)"
HALF_DAY = r"^([^ T]+)[ T]+(0?[1-9]|1[0-2])(:[0-9:.]+) *([AaPp])[Mm]$"

# A clock time followed by a zone: "…00:00Z", "…00:00:00+05:30", "…00:00 Europe/Paris".
ZONED_TEXT = r"[0-9]:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)? *([zZ]|[+-][0-9]{1,2}(:?[0-9]{2})?|[A-Za-z]{3,}(/[A-Za-z_]+)*) *$"

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Types that need no reading.
PLAIN = (*INTEGRAL, T.FloatType, T.DoubleType, T.TimestampNTZType)


def quoted(name: str) -> str:
    return f"`{name}`"


def coerce_numeric(name: str, dtype: T.DataType) -> str:
    """The column as bigint (integral input) or double; what cannot be read becomes null."""
    column = quoted(name)
    if isinstance(dtype, (T.LongType, T.DoubleType)):
        return column
    return f"CAST({column} AS BIGINT)" if isinstance(dtype, INTEGRAL) else f"TRY_CAST({column} AS DOUBLE)"


def coerce_float(name: str, dtype: T.DataType) -> str:
    return quoted(name) if isinstance(dtype, T.DoubleType) else f"TRY_CAST({quoted(name)} AS DOUBLE)"


def coerce_timestamp(name: str, dtype: T.DataType) -> str:
    """The column as a zone-free timestamp; unreadable text becomes null.

    A zoned column stops the job, as text that names a time zone does.
    """
    column = quoted(name)
    if isinstance(dtype, T.TimestampNTZType):
        return column
    if isinstance(dtype, T.TimestampType):
        raise ValueError("Zoned timestamps are not accepted; wall times must be free of a zone.")
    text = iso_time(column) if isinstance(dtype, T.StringType) else column
    return f"TRY_CAST({text} AS TIMESTAMP_NTZ)"


def iso_time(column: str) -> str:
    """Text of a time, respelled in the ISO form; other text stays and cannot be read.

    A date in any of ``SPELLINGS`` stands alone or before a clock time of 24 hours or, with AM or
    PM, of twelve. Text that names a time zone stops the job. Only text in another
    form goes through the steps, which are functions of their own, so that no text is searched
    twice and the generated code stays small.
    """
    stop = f"CAST(raise_error(concat('Timestamp text names a time zone: ', {column})) AS STRING)"
    dated = f"trim({column})"
    for pattern, iso in SPELLINGS.values():
        dated = f"regexp_replace({dated}, '{pattern}', '{iso}')"
    # A compact date without a time leaves the marks of one.
    dated = f"replace({dated}, ' ::', '')"
    known = ", ".join(f"'{m}'" for m in MONTHS)
    named = f"concat(left(t, 5), array_position(array({known}), lower(substr(t, 6, 3))), substr(t, 9))"
    numbered = f"IF(t RLIKE '^[0-9]{{4}}-[A-Za-z]{{3}}-', {named}, t)"
    part = [f"regexp_extract(t, '{HALF_DAY}', {n})" for n in range(5)]
    hour = f"(CAST({part[2]} AS INT) % 12 + IF(lower({part[4]}) = 'p', 12, 0))"
    whole_day = f"IF(t RLIKE '{HALF_DAY}', concat({part[1]}, ' ', {hour}, {part[3]}), t)"
    respelled = f"transform(transform(array({dated}), t -> {numbered}), t -> {whole_day})[0]"
    return (
        f"CASE WHEN {column} RLIKE '{ZONED_TEXT}' THEN {stop} WHEN {column} RLIKE '{ISO}' THEN {column} "
        f"ELSE {respelled} END"
    )


def time_spelling(column: str) -> str:
    """Name of the spelling that a text is read by, ``other`` if there is none; null for null or blank."""
    tests = " ".join(f"WHEN trim({column}) RLIKE '{p}' THEN '{name}'" for name, (p, _) in SPELLINGS.items())
    return f"CASE WHEN trim({column}) <> '' THEN CASE WHEN trim({column}) RLIKE '{ISO}' THEN 'iso' {tests} ELSE 'other' END END"


def is_finite(column: str) -> str:
    """Neither NaN nor infinite. NaN sorts above Infinity in Spark, so two bounds suffice."""
    return f"{column} > double('-Infinity') AND {column} < double('Infinity')"


def is_integral(column: str) -> str:
    return f"{column} = rint({column})"


def in_int32(column: str, dtype: T.DataType) -> str:
    suffix = "L" if isinstance(dtype, INTEGRAL) else "D"
    return f"{column} >= {INT32_FIRST}{suffix} AND {column} < {INT32_END}{suffix}"


def normalize_zero(column: str) -> str:
    """Negative zero becomes positive zero; equality does not tell them apart."""
    return f"CASE WHEN {column} = 0D THEN 0D ELSE {column} END"


def in_time_range(column: str) -> str:
    return f"{column} >= TIMESTAMP_NTZ '{TIME_FIRST}' AND {column} < TIMESTAMP_NTZ '{TIME_END}'"
