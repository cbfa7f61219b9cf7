"""Embedding whitening with MLlib's distributed block matrices.

The distinct vectors are the fit list. Its rows are centred exactly (whole
numbers until the last division), indexed and dealt into the blocks of a
``BlockMatrix``; its transpose times itself is the scatter, d x d, whose
eigenvectors are found by a local symmetric eigensolver. A product with the
whitening matrix projects the rows.

The middle dimension of the transposed product runs over all rows, so it is
split into many partial products, a few blocks each; otherwise MLlib would
send every block to the one task that owns the result's only block.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clusterlens.llm.common import stored

#: Rows and cells of one block.
BLOCK_ROWS, BLOCK_CELLS = 1 << 13, 1 << 20
#: Blocks that one partial product of the scatter takes.
SPLIT_BLOCKS = 4

RESULT = "vec_id {id}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _placed(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with each row's partition and place in it."""
    place = F.monotonically_increasing_id()
    return stored(df.withColumns({"__part": F.shiftright(place, 33), "__place": place.bitwiseAND(F.lit((1 << 33) - 1))}), name)


def _indexed(placed: DataFrame) -> DataFrame:
    """Row numbers 0, 1, ... without a sort: places within partitions, shifted by the sizes of the partitions before."""
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    return placed.join(before, "__part").withColumn("index", F.col("__before") + F.col("__place")).drop("__part", "__place", "__n", "__before")


def _blocks(rows: DataFrame, values: Column, n: int, d: int) -> BlockMatrix:
    """The n x d block matrix of rows (index, and ``values``, an array of doubles)."""
    frame = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(values).alias("vector")), "vector")
    return IndexedRowMatrix(frame, n, d).toBlockMatrix(max(1, min(BLOCK_ROWS, BLOCK_CELLS // d)), d)


def scatter(blocks: BlockMatrix) -> np.ndarray:
    """Transpose times matrix, as a local array."""
    splits = max(1, -(-blocks.numRowBlocks // SPLIT_BLOCKS))
    left = blocks.transpose()
    product = left._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, blocks.colsPerBlock).toLocalMatrix().toArray()


def project(blocks: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """Rows times ``weights`` (d x m): index, projected (an array of doubles)."""
    d, m = weights.shape
    spark_context = blocks.blocks.ctx
    right = BlockMatrix(spark_context.parallelize([((0, 0), Matrices.dense(d, m, weights.ravel(order="F")))], 1), blocks.colsPerBlock, m, d, m)
    rows = blocks.multiply(right).toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return frame.select(F.col(frame.columns[0]).alias("index"), vector_to_array(F.col(frame.columns[1])).alias("projected"))


def _numbers(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of the first ``most`` components whose eigenvalue is above rounding."""
    values, found = np.linalg.eigh((covariance + covariance.T) / 2)
    values, found = values[::-1], found[:, ::-1]
    keep = min(most, int((values > len(values) * np.finfo(np.float64).eps * max(values[0], 0)).sum()))
    return values[:keep], found[:, :keep]


def whiten(vectors: DataFrame, n_components: int = 16) -> DataFrame:
    """PCA-whitened coordinates of the rows of ``vectors`` (vec_id, vector array<long>), one row per row and component.

    Fitted to each distinct vector once: n of them with sums S per dimension,
    covariance with divisor n. Returns vec_id, component (from 1, by falling
    eigenvalue e), n, deviation (sum over dimensions of (n x - S)^2, exact),
    whitened ((x - S/n) on the component, over sqrt(e)), explained (e over
    the trace) and identity_error (the largest entry, by size, of the fit
    list's whitened covariance minus the identity).

    Rows with a null vector or component take no part. Of vectors of several
    lengths only the most common length does (of equally common ones the
    longest), as no covariance spans two lengths. Components whose eigenvalue
    is not above rounding have no scale and are left out; so a table without
    two distinct vectors gives no rows, nor does an empty one. Repeated and
    null ids keep a row each. A component's sign is arbitrary, the same for
    all rows. The d x d scatter passes the driver; no rows do.
    """
    spark = vectors.sparkSession
    whole = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    rows = _placed(vectors.select("vec_id", "vector").where(whole & (F.size("vector") > 0)), "vectors")
    nothing = spark.createDataFrame([], RESULT.format(id=vectors.schema["vec_id"].dataType.simpleString()))
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        return nothing
    d = size["d"]
    rows = rows.where(F.size("vector") == d)
    fit = _placed(rows.select("vector").distinct(), "fit-list")
    sums = fit.agg(F.count("*").alias("n"), *[F.sum(F.col("vector")[k]).alias(f"s{k}") for k in range(d)]).first()
    n, whole_means, rests = sums["n"], *zip(*[divmod(sums[f"s{k}"], sums["n"]) for k in range(d)], strict=True)

    # n x - S = n (x - S div n) - S mod n: whole numbers no larger than they must be.
    shifted = F.transform("vector", lambda x, k: (x - _numbers(whole_means)[k]) * F.lit(n) - _numbers(rests)[k])
    centred = F.transform(shifted, lambda x: x.cast("double") / F.lit(float(n)))
    deviation = F.aggregate(shifted, F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x.cast("decimal(19,0)") * x.cast("decimal(19,0)")).cast("decimal(38,0)"))

    fitted = _blocks(_indexed(fit), centred, n, d)
    covariance = scatter(fitted) / n
    values, found = components(covariance, n_components)
    if not len(values):
        return nothing
    weights = found / np.sqrt(values)

    # The whitened fit list, centred again and multiplied, must have the identity as its covariance.
    white = stored(project(fitted, weights), "whitened-fit")
    means = white.agg(*[F.avg(F.col("projected")[k]).alias(f"m{k}") for k in range(len(values))]).first()
    error = np.abs(scatter(_blocks(white, F.transform("projected", lambda x, k: x - _numbers(means)[k]), n, len(values))) / n - np.eye(len(values))).max()

    named = stored(_indexed(rows).select("index", "vec_id", deviation.alias("deviation"), centred.alias("centred")), "centred")
    ids = named.select("index", "vec_id", "deviation")
    # Rows of other lengths leave gaps in the numbers, which a block matrix allows.
    last = named.agg(F.max("index")).first()[0] + 1
    projected = project(_blocks(named, F.col("centred"), last, d), weights)
    explained = _numbers((values / np.trace(covariance)).tolist())
    return (
        projected.join(ids, "index")
        .select("vec_id", "deviation", F.posexplode("projected").alias("k", "whitened"))
        .select(
            "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
            explained[F.col("k")].alias("explained"), F.lit(float(error)).alias("identity_error"),
        )
    )
