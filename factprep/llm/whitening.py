"""Whitening of embeddings through MLlib's block matrices.

Entries become whole numbers, so that sums and deviations are exact. The rows, centred, are
indexed into a BlockMatrix of at most ``BLOCK_BYTES`` a block; its transpose times itself is the
scatter matrix, whose eigenvectors (numpy, one matrix as wide as a vector is long) give the
whitening matrix; the BlockMatrix times that projects the rows. The multiplication for the
scatter is split along the rows: every piece of blocks is multiplied in a task of its own and
only the products, as small as the scatter, are added up.

The whole path of the rows lies in the JVM. What the driver holds are one row of sums, the scatter matrix,
the number of rows of each partition, and MLlib's list of block numbers.

Rows whose vector is null or empty or holds a null, NaN or infinite entry are left out. All other
vectors must have one length; otherwise an error says so. Ids may be null, repeated or missing in
order: rows are told apart by their place in the stored table. Without rows, the result is empty.
A component without spread (an eigenvalue of at most ``FLAT`` of the largest) cannot be scaled and is
left out, so constant or repeated rows give fewer components.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factprep.llm.common import stored

#: Whole numbers of an entry: floor(SCALE * entry) + OFFSET.
SCALE = 1024
OFFSET = 100_000
#: Bytes of a block at most; rows of a block at least, or MLlib's bookkeeping of blocks outgrows the driver.
BLOCK_BYTES = 16 << 20
MOST_BLOCKS = 2048
FEWEST_ROWS = 1024
FLAT = 1e-12


def whole_entries(vector: str = "embedding") -> F.Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + OFFSET)


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite entries, and at least one."""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)


def indexed(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``index`` from 0 without gaps, ``vec_id`` and the whole entries ``x``, stored in the shared folder.

    The index is a row's place in its partition of the stored table plus the rows of the partitions before it.
    """
    place = F.monotonically_increasing_id()
    kept = usable(rows, vector).select(
        F.shiftright(place, 33).cast("int").alias("__part"),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"),
        F.col(vec_id).alias("vec_id"),
        whole_entries(vector).alias("x"),
    )
    placed = stored(kept, "vectors")
    before, starts = 0, []
    for part, count in sorted(tuple(r) for r in placed.groupBy("__part").agg(F.count("*")).collect()):
        starts.append((part, before))
        before += count
    # A row for each partition.
    starts = rows.sparkSession.createDataFrame(starts, "__part int, __start bigint")
    return placed.join(F.broadcast(starts), "__part").select((F.col("__start") + F.col("__at")).alias("index"), "vec_id", "x")


@dataclass(frozen=True)
class Sums:
    """Number of vectors and the exact sum of each dimension."""

    n: int
    sums: list[int]

    @property
    def means(self) -> list[float]:
        return [s / self.n for s in self.sums]


def sums_of(rows: DataFrame) -> Sums | None:
    lengths = rows.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("lo"), F.max(F.size("x")).alias("hi")).first()
    if not lengths.n:
        return None
    if lengths.lo != lengths.hi:
        raise ValueError(f"Vectors must have one length, not {lengths.lo} to {lengths.hi}.")
    summed = rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    return Sums(lengths.n, [int(r.s) for r in sorted(summed.collect())])


def block_rows(n: int, width: int) -> int:
    """Rows of a block: no more than fit BLOCK_BYTES, unless there were more than MOST_BLOCKS blocks."""
    fitting = max(FEWEST_ROWS, BLOCK_BYTES // (8 * width))
    return max(min(fitting, -(-n // 64)), -(-n // MOST_BLOCKS), FEWEST_ROWS)


def block_matrix(rows: DataFrame, means: list[float], n: int) -> BlockMatrix:
    """The centred rows as a BlockMatrix, one block wide."""
    mean = F.array(*[F.lit(m) for m in means])
    centred = F.zip_with(F.col("x"), mean, lambda x, m: x.cast("double") - m)
    vectors = rows.select("index", array_to_vector(centred).alias("vector"))
    old = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    return IndexedRowMatrix(old, n, len(means)).toBlockMatrix(block_rows(n, len(means)), len(means))


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix' transpose times itself."""
    own = matrix._java_matrix_wrapper._java_model
    # One piece for each row of blocks; MLlib adds the pieces' products up.
    product = own.transpose().multiply(own, own.numRowBlocks())
    width = int(own.numCols())
    local = np.array(list(product.toLocalMatrix().toArray()), float).reshape(width, width)
    return (local + local.T) / 2


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of those components that have spread."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    kept = values > FLAT * max(values[0], 0.0)
    return values[kept], vectors[:, kept]


def projected(spark: SparkSession, matrix: BlockMatrix, by: np.ndarray) -> BlockMatrix:
    """The matrix times a local one, sent as a block."""
    block = spark.sparkContext.parallelize([((0, 0), DenseMatrix(*by.shape, by.ravel(order="F")))], 1)
    return matrix.multiply(BlockMatrix(block, *by.shape))


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """``index`` and ``vector`` of a block matrix' rows."""
    indexed_rows = matrix.toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", indexed_rows._java_matrix_wrapper._java_model)
    return frame.select("index", vector_to_array("vector").alias("vector"))


def whitened(rows: DataFrame, most: int = 8, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each usable row and each of the ``most`` widest components, the row's whitened coordinate.

    ``n``: usable rows. ``deviation``: the row's exact squared distance from the mean, times n squared; beyond
    64 bits Spark raises. ``whitened``: the centred row projected on the component, over the root of its eigenvalue.
    ``explained``: the component's share of all variance. ``identity_error``: the largest absolute entry of the
    whitened rows' covariance minus the identity.
    """
    spark = rows.sparkSession
    key = rows.schema[vec_id].dataType.simpleString()
    schema = (
        f"vec_id {key}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    table = indexed(rows, vec_id, vector)
    sums = sums_of(table)
    if sums is None:
        return spark.createDataFrame([], schema)
    # Blocks are read by three multiplications; what memory does not hold lies on the executors' disks.
    matrix = block_matrix(table, sums.means, sums.n).persist(StorageLevel.MEMORY_AND_DISK)
    covariance = scatter(matrix) / sums.n
    values, vectors = components(covariance, most)
    if not len(values):
        matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
        return spark.createDataFrame([], schema)
    white = projected(spark, matrix, vectors / np.sqrt(values)).persist(StorageLevel.MEMORY_AND_DISK)
    error = float(np.abs(scatter(white) / sums.n - np.eye(len(values))).max())
    done = stored(rows_of(white), "whitened")
    for held in (white, matrix):
        held._java_matrix_wrapper._java_model.blocks().unpersist(False)
    shares = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)])
    exact = F.array(*[F.lit(s).cast("long") for s in sums.sums])
    gaps = F.zip_with("x", exact, lambda x, s: (x * F.lit(sums.n) - s))
    deviation = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g * g)
    return (
        table.select("index", "vec_id", deviation.alias("deviation"))
        .join(done, "index")
        .select("vec_id", "deviation", F.posexplode("vector").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(sums.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(shares, "at").alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
