"""Whitening of embeddings: blockwise QR, then the bidiagonal qd solver on the small factor.

The fit list is every distinct whole-number vector once. Its sums are exact; its rows are centred as
``(n x - S) / n``, of which only the division rounds. Every task reduces its rows, block after
block, to one triangular factor; sixteen factors at a time are stacked and reduced again until one
is left, of ``dims`` rows whatever the input. Singular values and vectors come from that factor
(``bidiagonal``), so the squares of the data are never formed. Factors are written to the shared
folder after every step, and only the last one and the sums reach the driver.

Vectors with null or non-finite entries go (``whole_vectors``), and so do those of another length
than ``dims``; without ``dims`` it is the commonest length, the larger of equals. Directions in
which the fit list does not vary can't be whitened and are left out: one vector, or an empty table,
gives no rows. Rows of one id, copies and null ids count each. A deviation beyond a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.bidiagonal import right_vectors
from tripmart.llm.vectors import matrix
from tripmart.session import keep

COMPONENTS = 4
#: Factors that one task of the tree reduces, and rows of one block.
FAN_IN = 16
BLOCK_ROWS = 4096

_LONG = 2**62


def commonest_length(vectors: DataFrame) -> int | None:
    """Length of most of the (non-empty) vectors."""
    lengths = vectors.where(F.size("x") > 0).groupBy(F.size("x").alias("d"))
    most = lengths.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return most["d"] if most else None


# ---------------------------------------------------------------- sums and deviations


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            if len(x) and int(np.abs(x.astype(np.float64)).max()) * len(x) >= _LONG:
                x = x.astype(object)
            total = [a + int(b) for a, b in zip(total, x.sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(dims), pa.int32()),
                pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
            ],
            names=["dim", "total"],
        )

    return run


def column_sums(fit: DataFrame, dims: int) -> list[int]:
    """Exact sum of every dimension: one number each reaches the driver."""
    parts = fit.select("x").mapInArrow(_sums(dims), "dim int, total decimal(38,0)")
    rows = parts.groupBy("dim").agg(F.sum("total").alias("total")).collect()
    found = {r["dim"]: int(r["total"]) for r in rows}
    return [found.get(k, 0) for k in range(dims)]


class Centre:
    """``n x - S`` of whole rows, exactly."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.most = max(map(abs, sums), default=0)

    def shifted(self, x: np.ndarray) -> np.ndarray:
        top = float(np.abs(x.astype(np.float64)).max(initial=0.0))
        if top * self.n + self.most < _LONG:
            return x.astype(np.int64) * self.n - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def centred(self, shifted: np.ndarray) -> np.ndarray:
        return shifted.astype(np.float64) / self.n

    def deviation(self, shifted: np.ndarray) -> list[int | None]:
        top = float(np.abs(shifted.astype(np.float64)).max(initial=0.0))
        if top * top * max(shifted.shape[1], 1) < _LONG:
            return (shifted * shifted).sum(1).tolist()
        wide = shifted.astype(object)
        return [s if s < 2**63 else None for s in (wide * wide).sum(1).tolist()]


# ---------------------------------------------------------------- blockwise QR


def _stacked(factor: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if factor is None else np.vstack([factor, rows]), mode="r")


def _factor_row(group: int, factor: np.ndarray) -> dict:
    return {
        "part": pa.array([group], pa.int64()),
        "factor": pa.array([np.ascontiguousarray(factor, "<f8").tobytes()], pa.binary()),
    }


def _task_factor(dims: int, centre: Centre):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = None
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            for start in range(0, len(x), BLOCK_ROWS):
                part = x[start : start + BLOCK_ROWS]
                factor = _stacked(factor, centre.centred(centre.shifted(part)))
        if factor is not None:
            yield pa.RecordBatch.from_pydict(_factor_row(TaskContext.get().partitionId(), factor))

    return run


def _merged(dims: int):
    def run(key: tuple, parts: pa.Table) -> pa.Table:
        factor = None
        for data in parts.sort_by("part").column("factor"):
            factor = _stacked(factor, np.frombuffer(data.as_py(), "<f8").reshape(-1, dims))
        return pa.table(_factor_row(key[0].as_py(), factor))

    return run


def triangular_factor(fit: DataFrame, dims: int, centre: Centre) -> np.ndarray:
    """``dims`` rows at most whose products equal those of all centred rows."""
    schema = "part bigint, factor binary"
    factors = keep(fit.select("x").mapInArrow(_task_factor(dims, centre), schema), "qr-factors")
    while factors.rows > 1:
        group = F.expr(f"part div {FAN_IN}")
        merged = factors.df.groupBy(group.alias("group")).applyInArrow(_merged(dims), schema)
        factors = keep(merged, "qr-factors")
    only = factors.df.first()
    if only is None:
        return np.zeros((0, dims))
    return np.frombuffer(only["factor"], "<f8").reshape(-1, dims)


# ---------------------------------------------------------------- the whole


def _identity_error(fit: DataFrame, dims: int, centre: Centre, directions: np.ndarray) -> float:
    """Largest entry of the whitened fit list's covariance minus the identity."""
    k = directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = centre.centred(centre.shifted(matrix(batch.column("x"), dims))) @ directions
            sums, products = sums + z.sum(0), products + z.T @ z
        line = np.append(sums, products)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(line)), pa.int32()), pa.array(line)], names=["place", "total"]
        )

    parts = fit.select("x").mapInArrow(run, "place int, total double")
    rows = parts.groupBy("place").agg(F.sum("total").alias("total")).collect()  # k + k * k rows
    line = np.zeros(k + k * k)
    for row in rows:
        line[row["place"]] = row["total"] / centre.n
    mean, products = line[:k], line[k:].reshape(k, k)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _projected(dims: int, centre: Centre, directions: np.ndarray):
    k = directions.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shifted = centre.shifted(matrix(batch.column("x"), dims))
            z = centre.centred(shifted) @ directions
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(len(z)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                    pa.array(np.repeat(np.array(centre.deviation(shifted), object), k), pa.int64()),
                    pa.array(z.reshape(-1)),
                ],
                names=["vec_id", "component", "deviation", "whitened"],
            )

    return run


_OUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)


def whitened(vectors: DataFrame, components: int = COMPONENTS, dims: int | None = None) -> DataFrame:
    """Every (id, x) vector along the ``components`` directions of most variance, in unit variance."""
    spark = vectors.sparkSession
    dims = commonest_length(vectors) if dims is None else dims
    if not dims:
        return spark.createDataFrame([], _OUT)
    vectors = vectors.where(F.size("x") == dims)
    fit = keep(vectors.select("x").distinct(), "fit-list")
    centre = Centre(fit.rows, column_sums(fit.df, dims))
    squares, directions, total = right_vectors(
        triangular_factor(fit.df, dims, centre), components
    )
    if not len(squares):
        return spark.createDataFrame([], _OUT)
    # Variances are squares / n, so unit variance asks for the root of n / squares.
    scaled = directions * np.sqrt(fit.rows / squares)
    explained = F.array(*[F.lit(float(s / total)) for s in squares])
    return (
        vectors.mapInArrow(
            _projected(dims, centre, scaled),
            "vec_id bigint, component int, deviation bigint, whitened double",
        )
        .withColumns(
            {
                "n": F.lit(fit.rows).cast("bigint"),
                "explained": explained[F.col("component") - 1],
                "identity_error": F.lit(_identity_error(fit.df, dims, centre, scaled)),
            }
        )
        .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
    )
