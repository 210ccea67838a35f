"""Row keys, bucket numbers and the exact text form of a row, as SQL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from factprep.functions.cleaning import quoted


def row_key(columns: Sequence[str]) -> str:
    """64-bit key of the row; equal rows have equal keys, in every process."""
    return f"xxhash64({', '.join(map(quoted, columns))})"


def bucket_id(columns: Sequence[str], buckets: int) -> str:
    """Bucket of the row, from ``hash``, which is also how Spark spreads a shuffle.

    Rows that were deduplicated on ``columns`` therefore already lie together
    by bucket whenever one of the bucket and shuffle-partition counts divides
    the other, and a bucketed write needs no further shuffle. Results never
    depend on that; only the number of files does.
    """
    return f"pmod(hash({', '.join(map(quoted, columns))}), {int(buckets)})"


def exact_text(column: str) -> str:
    """Text that is equal only for identical values; tells -0.0 from 0.0."""
    return f"CAST({column} AS STRING)"


def canonical_key(columns: Sequence[str]) -> str:
    """The row as one JSON list of exact texts."""
    return f"to_json(array({', '.join(exact_text(quoted(c)) for c in columns)}))"
