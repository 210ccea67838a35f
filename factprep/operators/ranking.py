"""Running totals and exact medians that no single task has to sort alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one range, and sampled rows that place each bound. Ranges steer the work only, never the result.
RANGE_ROWS = 100_000
SAMPLED = 20
#: Most bounds that become part of a plan. More ranges than this are cut inside wide ones.
MOST_RANGES = 1024


def _passed(bounds: Column, row: Column, most: int) -> Column:
    """How many of at most ``most`` sorted bounds are not above ``row``, by binary search."""
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= row), at + step
        ).otherwise(at),
    )


def _ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Add the range of each row: ``__wide``, and ``__part`` inside it; both follow ``order``.

    At most ``MOST_RANGES`` wide ranges have bounds that a sample of bounded size sets. If those would
    hold too many rows, each is cut again at bounds which its own sampled keys set, in a task
    of its own; they are joined to the rows, not collected. All samples are taken by hash, so that
    another reading of the rows finds the same bounds.
    """
    count = df.count()
    ranges = -(-count // RANGE_ROWS)
    if ranges <= 1:
        return df.withColumns({"__wide": F.lit(0), "__part": F.lit(0)})
    wide = min(MOST_RANGES, ranges)
    hashed = F.xxhash64(*order)
    keys = df.select(*order).distinct().orderBy(hashed, *order).limit(wide * SAMPLED)
    taken = sorted(tuple(r) for r in keys.collect())
    bounds = [taken[i * len(taken) // wide] for i in range(1, wide)]
    types = [df.schema[c].dataType for c in order]
    literal = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(b, types, order)]) for b in bounds])
    placed = df.withColumn("__wide", _passed(literal, F.struct(*order), wide))
    inner = -(-ranges // wide)
    if inner == 1:
        return placed.withColumn("__part", F.lit(0))
    # A wide range holds about 'inner' ranges, so about inner * SAMPLED of its keys are sampled.
    every = max(1, RANGE_ROWS // SAMPLED)
    sampled = placed.where(F.pmod(hashed, F.lit(every)) == 0).select("__wide", F.struct(*order).alias("key"))
    sorted_keys = F.array_sort(F.collect_set("key"))
    # Every SAMPLED-th key is a bound, however many rows this wide range turns out to have.
    cut = F.transform(
        F.sequence(F.lit(1), F.floor(F.size("keys") / SAMPLED).cast("int")),
        lambda n: F.get(F.col("keys"), n * SAMPLED - 1),
    )
    cuts = (
        sampled.groupBy("__wide")
        .agg(sorted_keys.alias("keys"))
        .where(F.size("keys") >= SAMPLED)
        .select("__wide", cut.alias("__cuts"))
    )
    # A search of any array below 2^30 bounds. Of a range without sampled keys, there is one part.
    part = F.coalesce(_passed(F.col("__cuts"), F.struct(*order), (1 << 30) - 1), F.lit(0))
    return placed.join(cuts, "__wide", "left").withColumn("__part", part).drop("__cuts")


def running_total(df: DataFrame, order: list[str], value: str, name: str = "running") -> DataFrame:
    """Add the running sum of ``value`` in ``order``, over the whole table.

    ``order`` must be unique per row and free of nulls. Rows are shuffled once, by
    range; totals per range, which need no shuffle of rows, give every range its
    starting value, and the sum inside runs in parallel. ``df`` is read three times: for
    the bounds, the totals and the rows. Beyond some 100 million rows it is read once more for each of the
    latter two, to cut ranges again.
    """
    ranged = _ranged(df, order)
    parts = ranged.groupBy("__wide", "__part").agg(F.sum(value).alias("__sum"))
    wides = parts.groupBy("__wide").agg(F.sum("__sum").alias("__all"))
    # At most MOST_RANGES rows, so this window and the broadcast are bounded.
    above = Window.orderBy("__wide").rowsBetween(Window.unboundedPreceding, -1)
    first = wides.select("__wide", F.coalesce(F.sum("__all").over(above), F.lit(0)).alias("__first"))
    before = Window.partitionBy("__wide").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        parts.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .join(F.broadcast(first), "__wide")
        .select("__wide", "__part", (F.col("__first") + F.col("__before")).alias("__start"))
    )
    inside = Window.partitionBy("__wide", "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.withColumn("__inside", F.sum(value).over(inside))
        .join(starts, ["__wide", "__part"])
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__wide", "__part", "__start", "__inside")
    )


def spread(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, median, minimum and maximum of ``value`` per group, all exact.

    The median is the middle value, or the mean of the two middle ones. Equal
    values are counted first; a group of any size is then ranked over many tasks.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    ranked = running_total(counted, [group, value], "n", "upto")
    groups = ranked.groupBy(group).agg(
        F.sum("n").alias("trials"),
        F.min(F.col("upto") - F.col("n")).alias("skip"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )
    first, last = F.col("upto") - F.col("n") - F.col("skip"), F.col("upto") - F.col("skip")
    low, high = F.floor((F.col("trials") + 1) / 2), F.floor(F.col("trials") / 2) + 1
    middle = (
        ranked.join(groups, group)
        .where((first < high) & (last >= low))
        .groupBy(group)
        .agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    )
    return groups.join(middle, group).select(
        group,
        "trials",
        ((F.col("__low") + F.col("__high")) / F.lit(2.0)).alias("median"),
        "minimum",
        "maximum",
    )
