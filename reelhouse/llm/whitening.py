"""Whitening of embeddings with Spark MLlib's block matrices.

Entries become whole numbers, so sums and deviations are exact. The centred rows are numbered without gaps and dealt into
the blocks of a BlockMatrix; its transpose times itself is the scatter matrix, as large as one vector squared, which alone
goes to the driver for its eigenvectors. A second block multiplication, by the whitening matrix, projects every row.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.session import written

#: Whole numbers of an entry: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Rows of a block at least, and blocks at most: the driver plans the multiplications by the blocks' places.
BLOCK_ROWS, BLOCKS = 2048, 65_536
#: Entries beyond this have no exact sums of squares in 38 digits; no embedding holds them.
LARGEST = 1e6
#: Eigenvalues up to this share of the largest, times the width, are zero but for rounding.
ZERO = 1e-13

_ROW_BITS = 33  # of monotonically_increasing_id


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and x (whole numbers) of the vectors that take part."""
    entry = F.col("embedding")
    whole = ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) > LARGEST))
    kept = vectors.where(entry.isNotNull() & (F.size(entry) > 0) & F.coalesce(whole, F.lit(False)))
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    return kept.select("vec_id", x.alias("x"))


def numbered(rows: DataFrame, purpose: str) -> DataFrame:
    """Adds `row`, 0 to n - 1 without gaps, fixed by writing the rows once; no sort."""
    dealt = written(rows.withColumn("_mono", F.monotonically_increasing_id()), purpose)
    part, local = F.shiftright("_mono", _ROW_BITS), F.col("_mono").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return dealt.withColumn("_part", part).withColumn("_local", local).join(starts, "_part").select(
        (F.col("_start") + F.col("_local")).alias("row"), *rows.columns
    )


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """Blocks of `rows` (row, values array<double>): whole columns, so a row lies in one block. JVM only."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("row").alias("index"), array_to_vector("values").alias("vector")), "vector")
    indexed = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, width))
    return indexed.toBlockMatrix(max(BLOCK_ROWS, math.ceil(n / BLOCKS)), width)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times matrix. The products of blocks are summed in as many tasks as the matrix has partitions."""
    left, right = matrix.transpose()._java_matrix_wrapper, matrix._java_matrix_wrapper
    splits = matrix.blocks.getNumPartitions()
    product = BlockMatrix(left.call("multiply", right._java_model, splits), matrix.colsPerBlock, matrix.colsPerBlock)
    found = product.toLocalMatrix().toArray()
    return (found + found.T) / 2


def times(matrix: BlockMatrix, local: np.ndarray) -> DataFrame:
    """row and values array<double> of the matrix times a small local one."""
    spark = matrix._java_matrix_wrapper._sc
    from pyspark.mllib.linalg import Matrices

    block = ((0, 0), Matrices.dense(*local.shape, local.T.ravel().tolist()))
    right = BlockMatrix(spark.parallelize([block], 1), matrix.colsPerBlock, local.shape[1])
    product = matrix.multiply(right).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    rows = MLUtils.convertVectorColumnsToML(rows, "vector")
    return rows.select(F.col("index").alias("row"), vector_to_array("vector").alias("values"))


def _identity_error(projected: DataFrame, n: int, width: int) -> float:
    """Largest absolute entry of the projections' covariance minus the identity, centred before multiplying."""
    means = projected.agg(*[(F.sum(F.get("values", F.lit(i))) / n).alias(f"m{i}") for i in range(width)]).first()
    centred = [F.get("values", F.lit(i)) - F.lit(means[i]) for i in range(width)]
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    sums = projected.agg(*[(F.sum(centred[i] * centred[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


OUTPUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = 8) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per usable row of `vectors` and component.

    A vector that is null, empty, or holds a null, a non-finite entry or one over a million in size takes no part; so do
    vectors of another length than most (equal counts: than the longest). Repeated rows and rows without vec_id count and
    come out each. Components are unit eigenvectors by falling eigenvalue, their largest entry positive; equal eigenvalues
    leave a choice, which is the same for all rows. Components without variance have no whitened form and are left out, so
    a single vector, equal vectors or an empty table give no row. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    fit = written(usable(vectors), "whitening-x")
    lengths = fit.groupBy(F.size("x").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], OUTPUT)
    width, n = lengths[0]["width"], lengths[0]["n"]
    fit = fit.where(F.size("x") == width)
    sums = fit.select(F.posexplode("x").alias("d", "c")).groupBy("d").agg(F.sum("c").alias("s")).collect()  # one row per dimension
    totals = F.lit([s["s"] for s in sorted(sums, key=lambda s: s["d"])]).cast("array<bigint>")
    rest = F.zip_with("x", totals, lambda c, s: c * F.lit(n) - s)
    zero = F.lit(0).cast("decimal(38,0)")
    square = F.aggregate("rest", zero, lambda a, r: (a + (r.cast("decimal(19,0)") * r.cast("decimal(19,0)")).cast("decimal(38,0)")).cast("decimal(38,0)"))
    centred = numbered(fit.withColumn("rest", rest).select("vec_id", square.alias("deviation"), F.transform("rest", lambda r: r.cast("double") / n).alias("values")), "whitening-centred")
    matrix = block_matrix(centred, n, width)
    covariance = scatter(matrix) / n
    values, directions = np.linalg.eigh(covariance)
    falling = np.argsort(-values, kind="stable")
    falling = falling[values[falling] > ZERO * width * max(values.max(), 0)][:components]
    if not len(falling):
        return spark.createDataFrame([], OUTPUT)
    chosen = directions[:, falling]
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(len(falling))])
    projected = written(times(matrix, chosen / np.sqrt(values[falling])), "whitening-projected")
    error = _identity_error(projected, n, len(falling))
    explained = F.lit((values[falling] / np.trace(covariance)).tolist()).cast("array<double>")
    cells = centred.select("row", "vec_id", "deviation").join(projected, "row").select("vec_id", "deviation", F.posexplode("values").alias("at", "whitened"))
    return cells.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
