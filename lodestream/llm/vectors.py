"""Which rows of a table of vectors take part, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (array of double) of the rows whose vector is whole.

    Dropped are null and empty vectors, those with null or non-finite entries,
    and those of another length than the commonest one (of equally common ones
    the longest), which have no place in one space.
    """
    read = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    read = read.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & ~odd)
    sizes = read.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return read.where(F.size("vector") == (sizes["size"] if sizes else 0))


def matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of an Arrow array of equally long lists as a matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)
