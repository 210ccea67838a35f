"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: its lines, long ones after the first end of a
sentence past PIECE characters. Each distinct paragraph's 64-bit digest goes into one
cell of each of three tables of TABLE cells; a cell keeps how many digests it has
got, their XOR and the XOR of their check values. Two sketches subtract cell by
cell. In the difference, a cell with a single digest (its check agrees) gives that
digest away, which then leaves its other cells, and so on: peeling recovers the
digests that only one of the texts has. If cells stay, the sketch was too
small: the digests are dealt by hash to as many sketches as their number calls for,
and those are peeled; sketches that fail again are dealt anew, finer and with another
seed, and what is left after RETRIES rounds is compared digest by digest.

The likeness of two fingerprints is the Jaccard index of their digest sets, from the
two sizes and the recovered digests. Everything is DataFrame expressions.

Null texts count as empty; an empty text has a sketch of empty cells, and two
empty sketches have likeness 1. Equal texts have equal fingerprints. Repeated
paragraphs of a text count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factprep.llm.common import LEAST_LONG, stored

PIECE = 240
TABLE = 16
ROUNDS = 12
#: Digests for each sketch of a retry, and digests up to which a row is retried in place.
DEALT, IN_PLACE = 16, 512
RETRIES = 4
CELL = "struct<n: int, k: long, q: long>"


def digests(text: Column) -> Column:
    """Sorted distinct digests of a text's paragraphs."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[^\n]{{1,{PIECE}}}[^\n.!?]*[.!?]*"), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p))))


def _keys(digests_sql: str) -> str:
    """Digests with check value and places."""
    return (
        f"transform(transform({digests_sql}, k -> named_struct('k', k, 'h', xxhash64(k, 17))), x -> named_struct("
        "'k', x.k, 'q', shiftrightunsigned(x.h, 32), 'a', cast(x.h & 15 AS int), "
        "'b', cast(shiftrightunsigned(x.h, 4) & 15 AS int), 'c', cast(shiftrightunsigned(x.h, 8) & 15 AS int)))"
    )


def cells_sql(digests_sql: str) -> str:
    """The sketch of an array of distinct digests."""
    table = lambda place: (
        f"transform(sequence(0, {TABLE - 1}), i -> aggregate(filter(keys, x -> x.{place} = i), "
        f"CAST(named_struct('n', 0, 'k', 0L, 'q', 0L) AS {CELL}), "
        f"(s, x) -> CAST(named_struct('n', s.n + 1, 'k', s.k ^ x.k, 'q', s.q ^ x.q) AS {CELL})))"
    )
    tables = ", ".join(table(p) for p in "abc")
    return f"transform(array({_keys(digests_sql)}), keys -> concat({tables}))[0]"


def subtract_sql(left: str, right: str) -> str:
    return (
        f"zip_with({left}, {right}, (l, r) -> "
        f"CAST(named_struct('n', l.n - r.n, 'k', l.k ^ r.k, 'q', l.q ^ r.q) AS {CELL}))"
    )


def peel_sql(cells: str) -> str:
    """Peels a difference: struct<cells, left: digests only in the left text, right: only in the right one>.

    The digests are complete if all cells have become zero.
    """
    found = (
        "transform(filter(s.cells, c -> abs(c.n) = 1 AND shiftrightunsigned(xxhash64(c.k, 17), 32) = c.q), "
        "c -> named_struct('n', c.n, 'k', c.k))"
    )
    places = (
        f"transform(array_distinct({found}), c -> transform(array(xxhash64(c.k, 17)), h -> named_struct("
        "'n', c.n, 'k', c.k, 'q', shiftrightunsigned(h, 32), 'at', array(cast(h & 15 AS int), "
        f"cast({TABLE} + (shiftrightunsigned(h, 4) & 15) AS int), "
        f"cast({2 * TABLE} + (shiftrightunsigned(h, 8) & 15) AS int))))[0])"
    )
    step = (
        "transform(s.cells, (c, i) -> aggregate(filter(pure, x -> x.at[0] = i OR x.at[1] = i OR x.at[2] = i), c, "
        f"(s, x) -> CAST(named_struct('n', s.n - x.n, 'k', s.k ^ x.k, 'q', s.q ^ x.q) AS {CELL})))"
    )
    state = f"struct<cells: array<{CELL}>, left: array<bigint>, right: array<bigint>>"
    only = lambda sign: f"transform(filter(pure, x -> x.n = {sign}), x -> x.k)"
    return (
        f"aggregate(sequence(1, {ROUNDS}), CAST(named_struct('cells', {cells}, 'left', array(), 'right', array()) AS {state}), "
        f"(s, r) -> transform(array({places}), pure -> IF(size(pure) = 0, s, CAST(named_struct('cells', {step}, "
        f"'left', concat(s.left, {only(1)}), 'right', concat(s.right, {only(-1)})) AS {state})))[0])"
    )


def peeled_sql(left: str, right: str) -> str:
    """struct<left, right> of the digests that two arrays don't share, by sketches; null if peeling fails."""
    peeled = peel_sql(subtract_sql(cells_sql(left), cells_sql(right)))
    return (
        f"transform(array({peeled}), s -> IF(exists(s.cells, c -> c.n != 0 OR c.k != 0L OR c.q != 0L), NULL, "
        "named_struct('left', s.left, 'right', s.right)))[0]"
    )


def _sums(peeled: str) -> str:
    return f"named_struct('l', size({peeled}.left), 'r', size({peeled}.right))"


def difference_sql(left: str, right: str) -> str:
    """struct<l, r>: how many digests only one array has; null if it takes another retry."""
    whole = f"transform(array({peeled_sql(left, right)}), p -> IF(p IS NULL, NULL, {_sums('p')}))[0]"
    deal = lambda side: f"filter({side}, d -> pmod(xxhash64(d, 1), parts) = part)"
    dealt = (
        f"transform(array(cast(ceil((size({left}) + size({right})) / {DEALT}) AS int)), parts -> "
        f"aggregate(sequence(0, parts - 1), CAST(named_struct('l', 0, 'r', 0) AS struct<l: int, r: int>), "
        f"(t, part) -> transform(array({peeled_sql(deal(left), deal(right))}), p -> IF(p IS NULL OR t IS NULL, NULL, "
        "CAST(named_struct('l', t.l + size(p.left), 'r', t.r + size(p.right)) AS struct<l: int, r: int>)))[0]))[0]"
    )
    size = f"size({left}) + size({right})"
    return (
        f"transform(array({whole}), w -> CASE WHEN w IS NOT NULL THEN w WHEN {size} > {IN_PLACE} THEN NULL ELSE {dealt} END)[0]"
    )


def retried(pairs: DataFrame) -> DataFrame:
    """(left, right, l, r) of pairs whose sketch was too small; left and right are digests of the digest arrays.

    ``pairs`` has left, right and the arrays left_digests, right_digests.
    """
    # The hash of a pair of arrays names it; each pair is taken once.
    pairs = pairs.groupBy("left", "right").agg(
        F.first("left_digests").alias("left_digests"), F.first("right_digests").alias("right_digests")
    )
    sized = pairs.withColumn("size", F.size("left_digests") + F.size("right_digests"))
    side = lambda name: sized.select(
        "left", "right", "size", F.lit(name == "left_digests").alias("own"), F.explode(name).alias("d")
    )
    rows, found = side("left_digests").unionAll(side("right_digests")), None
    for attempt in range(2, RETRIES + 2):
        finer = DEALT // 4 ** (attempt - 2) or 1
        part = F.pmod(F.xxhash64("d", F.lit(attempt)), F.ceil(F.col("size") / finer))
        named = ["left", "right", "size", "part"]
        last = attempt == RETRIES + 1
        gathered = rows.withColumn("part", part).groupBy(*named).agg(
            F.collect_list(F.when(F.col("own"), F.col("d"))).alias("x"),
            F.collect_list(F.when(~F.col("own"), F.col("d"))).alias("y"),
        )
        exact = "named_struct('l', size(array_except(x, y)), 'r', size(array_except(y, x)))"
        sums = exact if last else f"transform(array({peeled_sql('x', 'y')}), p -> IF(p IS NULL, NULL, {_sums('p')}))[0]"
        tried = stored(gathered.withColumn("sums", F.expr(sums)), "sketches")
        good = tried.filter("sums IS NOT NULL").select("left", "right", F.col("sums.l").alias("l"), F.col("sums.r").alias("r"))
        found = good if found is None else found.unionAll(good)
        bad = tried.filter("sums IS NULL")
        if last or bad.isEmpty():
            break
        again = lambda name, own: bad.select(
            "left", "right", "size", F.lit(own).alias("own"), F.explode(name).alias("d")
        )
        rows = again("x", True).unionAll(again("y", False))
    return found.groupBy("left", "right").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))


def likeness(left: str, right: str, l: str, r: str) -> Column:  # noqa: E741
    """Jaccard index from the sizes of two digest arrays and the digests that only one has."""
    return F.expr(
        f"CASE WHEN size({left}) + {r} = 0 THEN 1.0D ELSE (size({left}) - {l}) / CAST(size({left}) + {r} AS double) END"
    )


def fingerprint(digest_column: str) -> Column:
    """The sketch as text: digests, then the cells as count:digests:checks in hexadecimal."""
    return F.expr(
        f"concat_ws('.', lower(hex(size({digest_column}))), transform({cells_sql(digest_column)}, "
        "c -> concat(lower(hex(c.n)), ':', lower(hex(c.k)), ':', lower(hex(c.q)))))"
    )


def with_likeness(rows: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """The rows with a likeness column for each pair of digest columns; cuts the lineage once."""
    for name, (left, right) in pairs.items():
        rows = rows.withColumn(f"__{name}", F.expr(difference_sql(left, right)))
    rows = stored(rows, "compared")
    for name, (left, right) in pairs.items():
        failed = rows.filter(F.col(f"__{name}").isNull())
        keys = {"__left": F.xxhash64(left, F.lit(5)), "__right": F.xxhash64(right, F.lit(7))}
        if failed.isEmpty():
            rows = rows.withColumns({f"__{name}_l": F.col(f"__{name}.l"), f"__{name}_r": F.col(f"__{name}.r")})
        else:
            more = retried(
                failed.select(
                    keys["__left"].alias("left"), keys["__right"].alias("right"),
                    F.col(left).alias("left_digests"), F.col(right).alias("right_digests"),
                )
            )
            more = stored(
                more.select(
                    F.col("left").alias("__left"), F.col("right").alias("__right"), F.lit(True).alias("__open"),
                    F.col("l").alias("__l"), F.col("r").alias("__r"),
                ),
                "retried",
            )
            # Rows that need no retry are not open, match nothing and spread by their own digests.
            rows = (
                rows.withColumns({**keys, "__open": F.col(f"__{name}").isNull()})
                .join(more, ["__left", "__right", "__open"], "left")
                .withColumns(
                    {
                        f"__{name}_l": F.coalesce(F.col("__l"), F.col(f"__{name}.l")),
                        f"__{name}_r": F.coalesce(F.col("__r"), F.col(f"__{name}.r")),
                    }
                )
                .drop("__left", "__right", "__open", "__l", "__r")
            )
        rows = rows.withColumn(name, likeness(left, right, f"__{name}_l", f"__{name}_r")).drop(
            f"__{name}", f"__{name}_l", f"__{name}_r"
        )
    return rows


# --- the next document ------------------------------------------------------


#: Ids of a range in which neighbours are found.
RANGE_ROWS = 1 << 20


def next_ids(docs: DataFrame) -> DataFrame:
    """(__id, __next, __rows) of every distinct id: the next one in descending order; after the last, the first.

    Spark cuts the ids into ranges of like numbers of ids, whatever their values. Neighbours are found inside the
    ranges, and between them in one window over a row for each range. A null id is last.
    """
    ids = stored(docs.groupBy("__id").agg(F.count("*").alias("__rows")), "ids")
    ranges = max(int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-ids.count() // RANGE_ROWS))
    # Stored, so that a range is the same however often its task runs.
    ranged = stored(ids.repartitionByRange(ranges, "__id").withColumn("__range", F.spark_partition_id()), "ranges")
    inner = ranged.withColumn("__next", F.lead("__id").over(Window.partitionBy("__range").orderBy(F.desc("__id"))))
    order = Window.orderBy(F.desc("__top"))
    after = (
        ranged.groupBy("__range")
        .agg(F.max("__id").alias("__top"))
        .withColumn("__after", F.coalesce(F.lead("__top").over(order), F.first("__top").over(order)))
    )
    joined = inner.join(after.select("__range", "__after"), "__range")
    return joined.select("__id", F.coalesce("__next", "__after").alias("__next"), "__rows")


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Each document with an edited text, whose last half is replaced by the start of the next document.

    Returns doc_id, n_chars, edited_sha256, and digest arrays own, edited and next.
    Of rows that share an id, the least text is the next document of others. An id of -2^63 counts as null.

    Texts are shuffled once, by id; what a document lends to the one before it, no more than that
    one takes, is shuffled to that one's id.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_LONG)).alias("__id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    halves = rows.groupBy("__id").agg(F.max(F.floor(F.length("text") / 2)).alias("__most"))
    ids = stored(next_ids(rows.select("__id")).join(halves, "__id"), "next")
    lent = ids.select(F.col("__next").alias("__id"), F.col("__id").alias("__to"), "__most")
    placed = rows.join(ids.select("__id", "__rows").join(lent, "__id"), "__id")
    # Both sides read the same shuffle of the texts.
    given = placed.select("__to", "__most", "__rows", "__id", "text")
    if not ids.filter("__rows > 1").isEmpty():
        several = given.filter("__rows > 1").groupBy("__to", "__most", "__rows", "__id").agg(F.min("text").alias("text"))
        given = given.filter("__rows = 1").unionAll(several)
    heads = given.select(
        F.col("__to").alias("__id"),
        F.expr("substring(text, 1, int(__most))").alias("__head"),
        digests(F.col("text")).alias("next"),
    )
    half = F.expr("CAST(floor(length(text) / 2) AS int)")
    edited = F.expr("concat(substring(text, 1, length(text) - __half), substring(__head, 1, __half))")
    paired = placed.select("__id", "text").join(heads, "__id")
    return paired.withColumn("__half", half).withColumn("__edited", edited).select(
        F.expr(f"nullif(__id, {LEAST_LONG + 1}L - 1L)").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("__edited")).alias("edited"),
        "next",
    )
