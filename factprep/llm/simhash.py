"""SimHash near-duplicates by the generalised pigeonhole principle.

A text's fingerprint has 64 bits; each is the majority of that bit over the
XXH64 hashes of the text's word shingles. Two texts are linked if their
fingerprints differ in at most ``distance`` bits.

Bits are grouped into parts, correlated bits together. If the parts' thresholds
plus one add up to ``distance`` plus one, two linked fingerprints lie within the
threshold in at least one part, whatever the number of parts. The number of
parts and their unequal thresholds come from dynamic programming on candidate
counts estimated from a sample of fingerprints (documented bound: SAMPLE; it
steers cost only, never results). Every fingerprint is filed under its exact
part values, looked up under all part values within the thresholds, and pairs
that meet are verified on all bits.

Copies are one fingerprint. A bucket never yields its pairs: a task compares a
block of it and returns a spanning forest of the links. Buckets larger than a
block are cut into blocks, and each pair of blocks is its own group. Components
come from alternating large and small stars over written tables.

Null and empty texts have fingerprint 0 and are linked like any other. Equal
rows share a component; null ids never become a component's name, so a component
of nulls alone has a null name. Other columns pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factprep.llm.common import longs, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
SAMPLE = 2048
LEAST_BLOCK, MOST_BLOCK = 1024, 65_536
MOST_VARIANTS = 1024
#: Costs in microseconds of one row filed or looked up, and of one pair compared.
ROW_COST, PAIR_COST = 3.0, 0.02
CHUNK = 65_536


def simhash(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a whole UTF-8 text as a signed 64-bit number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    digest, totals, count = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(starts)
    for at in range(0, count, CHUNK):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=True)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        totals += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * totals > count).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle) for t in texts], dtype="int64")

    # Were it deterministic to Spark, a filter or join on the result would run it again in workers of its own.
    return docs.withColumn(name, fingerprints.asNondeterministic()(F.col(text).cast("binary")))


# --- parts and thresholds ---------------------------------------------------


def group_bits(sample: np.ndarray, parts: int) -> list[int]:
    """Masks of equal size; each part gathers the bits most correlated with its first."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    spread = bits.std(axis=0)
    like = np.zeros((BITS, BITS))
    if len(sample) > 1:
        centred = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
        like = np.abs(centred.T @ centred) / len(sample)
        like[spread == 0] = like[:, spread == 0] = 1  # constant bits tell nothing: they belong together
    free, masks = list(range(BITS)), []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        part = [max(free, key=lambda b: (like[b, free].sum(), -b))]
        while len(part) < size:
            part.append(max((b for b in free if b not in part), key=lambda b: (like[b, part].sum(), -b)))
        free = [b for b in free if b not in part]
        masks.append(sum(1 << b for b in part))
    return masks


def close_share(sample: np.ndarray, mask: int, most: int) -> list[float]:
    """Estimated share of pairs within 0, 1, ... most bits in a part; at least that of independent bits."""
    width = mask.bit_count()
    values, seen = sample & np.uint64(mask), np.zeros(most + 1)
    for i in range(0, len(values), 256):
        apart = np.bitwise_count(values[i : i + 256, None] ^ values[None, :])
        seen += [(apart <= d).sum() for d in range(most + 1)]
    pairs = max(1, len(values) * (len(values) - 1))
    return [
        max((seen[d] - len(values)) / pairs, sum(comb(width, j) for j in range(d + 1)) / 2.0**width)
        for d in range(most + 1)
    ]


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, -1 for an unused part, with (threshold + 1) adding up to total at least cost.

    costs[i][t] is the cost of threshold t - 1 in part i.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(part):
                if used + t <= total and (used + t not in step or cost + more < step[used + t][0]):
                    step[used + t] = (cost + more, [*chosen, t - 1])
        best = step
    return best[total]


def flips(mask: int, threshold: int) -> list[int]:
    """Every way to change at most ``threshold`` bits of a part; the first changes none."""
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    out = level = [0]
    for _ in range(threshold):
        level = sorted({f | b for f in level for b in bits if not f & b})
        out = out + level
    return list(dict.fromkeys(out))


def plan_parts(sample: np.ndarray, rows: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(mask, threshold) of the parts that are used."""
    options = []
    for parts in range(1, distance + 2):
        masks = group_bits(sample, parts)
        costs = []
        for mask in masks:
            share, part = close_share(sample, mask, distance), [0.0]
            for t in range(distance + 1):
                variants = sum(comb(mask.bit_count(), j) for j in range(t + 1))
                cost = rows * variants * ROW_COST + share[t] * rows * rows / 2 * PAIR_COST
                part.append(cost if variants <= MOST_VARIANTS else float("inf"))
            costs.append(part)
        cost, thresholds = allocate(costs, distance + 1)
        options.append((cost, parts, [(m, t) for m, t in zip(masks, thresholds, strict=True) if t >= 0]))
    return min(options)[2]


# --- links ------------------------------------------------------------------


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, root) with the components of the given links."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


#: Pairs of one bucket that are compared at a time.
SLICE = 1 << 22


def _compare(distance: int):
    edge = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(group: np.ndarray, prints: np.ndarray, filed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links within groups of sorted rows; the filed rows of a group come first."""
        us, vs = [], []
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(starts, len(group)))
        for s, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
            all_of, first = prints[s : s + n], prints[s : s + n][filed[s : s + n]]
            # A running forest: no more edges than rows are ever held beside a slice's pairs.
            x = y = np.zeros(0, np.uint64)
            step = max(1, SLICE // n)
            for i in range(0, len(first), step):
                a, b = np.nonzero(np.bitwise_count(first[i : i + step, None] ^ all_of[None, :]) <= distance)
                u, v = first[i : i + step][a], all_of[b]
                u, v = u[u != v], v[u != v]
                if len(u):
                    x, y = forest(np.concatenate((x, u)), np.concatenate((y, v)))
            if len(x):
                us.append(x)
                vs.append(y)
        small = np.repeat(sizes <= 64, sizes)
        group, prints, filed = group[small], prints[small], filed[small]
        for step in range(1, min(64, len(group))):
            near = (group[step:] == group[:-step]) & filed[:-step]
            if not (group[step:] == group[:-step]).any():
                break
            near &= (np.bitwise_count(prints[step:] ^ prints[:-step]) <= distance) & (prints[step:] != prints[:-step])
            us.append(prints[:-step][near])
            vs.append(prints[step:][near])
        if not us:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return np.concatenate(us), np.concatenate(vs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            group = rows["g"].to_numpy()
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next batch
            rest, rows = rows.slice(cut), rows.slice(0, cut)
            yield from flush(rows)
        if rest is not None:
            yield from flush(rest)

    def flush(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        group, prints = rows["g"].to_numpy(), rows["print"].to_numpy().view(np.uint64)
        filed = rows["flip"].to_numpy() == 0
        # A group holds one bucket or, where hashes agree, several: links are verified, so no harm is done.
        u, v = links(group, np.ascontiguousarray(prints), filed)
        if len(u):
            u, v = forest(u.view(np.int64), v.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=edge)

    return run


def link_edges(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (u, v) whose components are those of all links between the distinct ``print`` values."""
    spark = prints.sparkSession
    rows = prints.count()
    taken = prints.orderBy(F.xxhash64("print"), "print").limit(SAMPLE).collect()
    sample = np.array([r["print"] for r in taken], np.int64).view(np.uint64)
    if rows < 2:
        return spark.createDataFrame([], "u long, v long")
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    chosen, probes = plan_parts(sample, rows, distance), []
    for part, (mask, threshold) in enumerate(chosen):
        key = F.col("print").bitwiseAND(F.lit(signed(mask)))
        flipped = F.explode(longs(map(signed, flips(mask, threshold))))
        probes.append(
            prints.select("print", key.alias("own"), flipped.alias("flip")).select(
                F.xxhash64(F.lit(part), F.col("own").bitwiseXOR(F.col("flip"))).alias("bucket"), "print", "flip"
            )
        )
    filed = probes[0]
    for more in probes[1:]:
        filed = filed.unionAll(more)
    expected = rows * sum(len(flips(m, t)) for m, t in chosen)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    block = int(min(MOST_BLOCK, max(LEAST_BLOCK, 2 * expected / parts)))
    sizes = filed.groupBy("bucket").agg(F.count("*").alias("n"))
    # Stored, as only a join of two shuffles is split where one key has many rows.
    large = stored(
        sizes.filter(F.col("n") > block).select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")),
        "large",
    )
    placed = filed.join(large, "bucket", "left")
    own = F.pmod(F.xxhash64("print", F.lit("block")), F.col("blocks")).cast("int")
    # A row of a large bucket goes to every pair of blocks that holds its own.
    grouped = placed.select(
        "bucket", "print", "flip", F.col("blocks"), F.when(F.col("blocks").isNotNull(), own).alias("own")
    ).select(
        "print",
        "flip",
        F.explode(
            F.expr(
                "CASE WHEN blocks IS NULL THEN array(bucket) ELSE "
                "transform(sequence(0, blocks - 1), b -> xxhash64(bucket, least(b, own), greatest(b, own))) END"
            )
        ).alias("g"),
    )
    dealt = grouped.repartition(parts, "g").sortWithinPartitions("g", F.col("flip") != 0)
    return dealt.mapInArrow(_compare(distance), "u long, v long").distinct()


# --- components -------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges that isn't a component's smallest."""
    size = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    known = size(now)
    while known[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("low")), "lowest")
        large = stored(
            both.join(low, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
            .distinct(),
            "links",
        )
        low = stored(large.groupBy("u").agg(F.min("v").alias("low")), "lowest")
        small = large.join(low, "u")
        now = stored(
            small.select("u", F.col("low").alias("v"))
            .unionAll(small.filter("v > low").select(F.col("v").alias("u"), F.col("low").alias("v")))
            .distinct(),
            "links",
        )
        found = size(now)
        if found == known:
            break
        known = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def with_roots(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Distinct ``print`` values and what is known of each, with their component's ``root``, which is never null."""
    roots = components(link_edges(distinct.select("print"), distance))
    return distinct.join(roots, F.col("print") == F.col("node"), "left").select(
        *distinct.columns, F.coalesce("root", "print").alias("root")
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fingerprint as 16 hexadecimal digits, component_id): one row for each row."""
    prints = stored(
        with_fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "print", shingle)
        .select("doc_id", "print"),
        "fingerprints",
    )
    distinct = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct")
    member = with_roots(distinct, distance)
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    place = member.join(named, "root").select("print", "component_id")
    return prints.join(place, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id.

    Groups are told apart by their root, not by their name, as groups without an id
    have none and groups that share an id may share a name. A group without any id
    keeps one of its documents. Of rows of a group that share the smallest id, the
    one with the least fingerprint and text digest stays, whichever if they agree.
    """
    digest = F.sha2(F.col(text).cast("binary"), 256)
    own = with_fingerprints(docs, text, "__own").withColumn("__digest", digest)
    prints = stored(own.select(F.col(doc_id).alias("doc_id"), F.col("__own").alias("print"), F.col("__digest").alias("digest")), "fingerprints")
    # Equal rows are counted first, so that rows of one fingerprint are spread by id and text.
    alike = prints.groupBy("print", "doc_id", "digest").agg(F.count("*").alias("rows"))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "print", "digest", "rows")
    distinct = stored(alike.groupBy("print").agg(F.min(first).alias("first")), "distinct")
    chosen = with_roots(distinct).groupBy("root").agg(F.min("first").alias("first"))
    keep = stored(
        chosen.select(
            F.col("first.doc_id").alias("__keep"),
            F.col("first.print").alias("__print"),
            F.col("first.digest").alias("__text"),
            F.col("first.rows").alias("__rows"),
        ),
        "kept",
    )
    same = (
        own[doc_id].eqNullSafe(keep["__keep"])
        & (own["__own"] == keep["__print"])
        & own["__digest"].eqNullSafe(keep["__text"])
    )
    kept = own.join(keep, same).drop("__own", "__digest", "__keep", "__text")
    single = kept.filter("__rows = 1").drop("__print", "__rows")
    if keep.agg(F.max("__rows")).first()[0] in (None, 1):
        return single
    # A fingerprint is in one group only, so it tells groups apart.
    several = kept.filter("__rows > 1").dropDuplicates(["__print"]).drop("__print", "__rows")
    return single.unionAll(several)
