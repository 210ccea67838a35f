"""The speed formula and the cleaner as Python functions, for comparison with the native forms."""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factprep.contract import FactContract
from factprep.functions.cleaning import INT32_END, INT32_FIRST, TIME_END, TIME_FIRST
from factprep.operators.cleaning import coerce

# Executors receive these functions whole and need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def python_speed(distance: float, duration: float) -> float:
    """Reference form of the speed: Python arithmetic and Python rounding."""
    if not duration > 0 or not math.isfinite(distance):
        raise ValueError("A speed needs a positive duration and a finite distance.")
    return round(distance * 3600.0 / duration, 6)


def speed_scalar(distance: str, duration: str) -> Column:
    """One Python call and one pickled row at a time."""
    return F.udf(python_speed, T.DoubleType(), useArrow=False)(F.col(distance), F.col(duration))


def speed_arrow(distance: str, duration: str) -> Column:
    """The same function over Arrow batches."""

    @F.pandas_udf(T.DoubleType())
    def batch(distances: pd.Series, durations: pd.Series) -> pd.Series:
        return pd.Series(map(python_speed, distances.tolist(), durations.tolist()), dtype="float64")

    return batch(F.col(distance), F.col(duration))


def _batch_cleaner(contract: FactContract) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    columns, integers, times = contract.columns, contract.integers, contract.times
    distance, start, end = contract.distance, contract.start, contract.end
    first, last = (pa.scalar(pd.Timestamp(t).to_pydatetime(), pa.timestamp("us")) for t in (TIME_FIRST, TIME_END))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = {c: batch.column(c) for c in columns}
            tests = []
            for c in columns:
                if c in times:
                    tests += [pc.greater_equal(values[c], first), pc.less(values[c], last)]
                    continue
                if pa.types.is_floating(values[c].type):
                    tests.append(pc.is_finite(values[c]))
                    if c in integers:
                        tests.append(pc.equal(values[c], pc.trunc(values[c])))
                if c in integers:
                    tests.append(pc.greater_equal(values[c], pa.scalar(INT32_FIRST, values[c].type)))
                    tests.append(pc.less(values[c], pa.scalar(INT32_END, values[c].type)))
            tests.append(pc.greater(values[distance], 0.0))
            tests.append(pc.greater(values[end], values[start]))
            kept = pa.table(values).filter(functools.reduce(pc.and_, tests), null_selection_behavior="drop")
            cleaned = {
                # x + 0.0 turns -0.0 into 0.0
                c: kept[c] if c in times else kept[c].cast(pa.int64()) if c in integers else pc.add(kept[c], 0.0)
                for c in columns
            }
            yield from pa.table(cleaned).to_batches()

    return clean


def clean_in_arrow(df: DataFrame, contract: FactContract) -> DataFrame:
    """The cleaning contract with its rules as one Arrow batch function.

    Types are brought in line by the same expressions as for ``clean``: text is read, what
    cannot be read counts as missing, and a zone stops the job.
    """
    return coerce(df, contract).mapInArrow(_batch_cleaner(contract), contract.clean_schema())
