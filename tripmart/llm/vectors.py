"""Whole-number vectors of an embeddings table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def whole_vectors(
    rows: DataFrame, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE
) -> DataFrame:
    """(id, x): ``floor(scale * component)`` of every vector without null or non-finite entries.

    ``x`` is an array of longs; what a long cannot hold becomes the nearest one. Null vectors go,
    empty ones stay. Ids may be null or repeated.
    """

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))

    vector = F.col(column).cast("array<double>")
    kept = rows.where(F.col(column).isNotNull() & F.forall(vector, finite))
    return kept.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.transform(vector, lambda c: F.floor(c * scale)).alias("x"),
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``dims`` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
