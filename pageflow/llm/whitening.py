"""Embeddings turned to uncorrelated components of variance one.

The covariance comes from variances alone: every task adds up the squares of each centred dimension and of the sum of each
two, and as (a + b)^2 - a^2 - b^2 = 2ab, differences give all products. All of it is in whole numbers and exact. Each dimension
is centred on the whole number nearest to its mean before it is squared, which keeps squares small; what is left of the mean is
taken off exactly at the end. The matrix is as large as the square of the dimensions and is decomposed by the driver.
"""

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pageflow.llm.common import prepared, table
from pageflow.llm.dense import LONG, exact_sum, floors, matrix, most, totals, usable

SCALE, COMPONENTS = 64, 32
# Dimensions at most: their squared number of products is held by every task.
MOST_DIMENSIONS = 4096
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """Mean of a dimension: centre + rest / n. `axes` are unit eigenvectors as columns by falling eigenvalue."""
    n: int
    centre: list[int]
    rest: list[int]
    covariance: np.ndarray
    axes: np.ndarray
    eigenvalues: np.ndarray
    explained: list

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied with; NaN for a component without variance beyond rounding."""
        least = self.eigenvalues.max(initial=0.0) * len(self.centre) * np.finfo(float).eps
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.eigenvalues > least, 1 / np.sqrt(self.eigenvalues), np.nan)

    def centred(self, column: pa.Array) -> np.ndarray:
        """Whole numbers less the centre."""
        x = floors(matrix(column, len(self.centre)), SCALE)
        return x - np.array(self.centre, object if x.dtype == object or max(map(abs, self.centre), default=0) > 2 ** 61 else np.int64)

    def whitened(self, y: np.ndarray) -> np.ndarray:
        means = np.array([r / self.n for r in self.rest])
        return (y.astype(np.float64) - means) @ self.axes * self.scales

    def deviations(self, y: np.ndarray) -> list:
        """Sum of (n x - S)^2 over the dimensions of each row; None where it is beyond LONG."""
        largest = self.n * (most(y) + 1)
        if y.dtype != object and y.shape[1] * largest * largest <= LONG:
            d = y * np.int64(self.n) - np.array(self.rest, np.int64)
            return (d * d).sum(axis=1).tolist()
        d = y.astype(object) * self.n - np.array(self.rest, object)
        return [v if v <= LONG else None for v in map(int, (d * d).sum(axis=1))]


def pair_squares(y: np.ndarray):
    """For each dimension i the sums over rows of y_i^2 and of (y_i + y_j)^2, j > i."""
    limit = 2 * most(y)
    if y.dtype != object and limit * limit * max(1, len(y)) > LONG:
        y = y.astype(object)
    for i in range(y.shape[1]):
        one, both = y[:, i:i + 1], y[:, i:i + 1] + y[:, i + 1:]
        yield i, np.concatenate([(one * one).sum(axis=0), (both * both).sum(axis=0)]).astype(object)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the usable rows; None if there are none or they have no dimension."""
    found = usable(rows).agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("width")).first()
    n, width = found["n"], found["width"] or 0
    if width > MOST_DIMENSIONS:
        raise ValueError(f"{width} dimensions, at most {MOST_DIMENSIONS} are supported")
    if not width:
        return None
    vectors = usable(rows).select("embedding")
    sums = totals(vectors, lambda batch: [(0, exact_sum(floors(matrix(batch.column(0), width), SCALE)))])
    centre = [round(Fraction(sums[i], n)) for i in range(width)]
    model = Whitening(n, centre, [sums[i] - n * c for i, c in enumerate(centre)], np.empty(0), np.empty(0), np.empty(0), [])
    squares = totals(vectors, lambda batch: ((i * width + i, s) for i, s in pair_squares(model.centred(batch.column(0)))))
    # n^3 times a variance, of a dimension or of the sum of two.
    own = [n * (n * squares[i * width + i] - model.rest[i] ** 2) for i in range(width)]
    cov = np.empty((width, width))
    for i in range(width):
        cov[i, i] = own[i] / n ** 3
        for j in range(i + 1, width):
            both = n * (n * squares[i * width + j] - (model.rest[i] + model.rest[j]) ** 2)
            cov[i, j] = cov[j, i] = (both - own[i] - own[j]) / (2 * n ** 3)
    values, axes = np.linalg.eigh(cov)
    first = np.argsort(-values, kind="stable")[:components]
    axes = axes[:, first]
    axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(first))])
    trace = float(sum(cov.diagonal()))
    model.covariance, model.axes, model.eigenvalues = cov, axes, values[first]
    model.explained = [float(max(0.0, e) / trace) if trace > 0 else None for e in values[first]]
    return model


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the covariance of the whitened rows less the identity, over components that have variance."""
    good = np.flatnonzero(~np.isnan(model.scales))
    if not len(good):
        return None

    def moments(batches):
        total, products = np.zeros(len(good)), np.zeros((len(good), len(good)))
        for batch in batches:
            w = model.whitened(model.centred(batch.column(0)))[:, good]
            total, products = total + w.sum(axis=0), products + w.T @ w
        values = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["slot", "value"])

    sent = usable(rows).select("embedding").mapInArrow(moments, "slot bigint, value double")
    added = {r["slot"]: r["value"] for r in sent.groupBy("slot").agg(F.sum("value").alias("value")).collect()}
    values = np.array([added[k] for k in range(len(added))]) / model.n
    mean, products = values[:len(good)], values[len(good):].reshape(len(good), -1)
    # The rows are centred as they are; what rounding left of the mean is taken off.
    return float(np.abs(products - np.outer(mean, mean) - np.eye(len(good))).max())


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error for each row and component (32 at most).

    Rows whose embedding is null or holds null or non-finite components, or any beyond single precision, take no part; rows of
    null, equal or repeated ids are vectors of their own. Shorter vectors count as filled up with zeros. A deviation beyond
    LONG is null. Components without variance have whitened null and do not count for identity_error, and if nothing varies
    (one row, or equal rows) explained and identity_error are null. No usable rows, or only empty vectors, give no rows.
    Adding the same number to all entries changes none of these, so it is left out. Equal eigenvalues may come with any
    axes of their space. Other columns are ignored.
    """
    model = fit(rows, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], OUT)
    error = identity_error(rows, model)

    def project(batches):
        for batch in batches:
            y = model.centred(batch.column("embedding"))
            w = model.whitened(y)
            flat = pa.array(w.ravel(), from_pandas=True)  # NaN to null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(model.deviations(y), pa.int64()), lists], ["vec_id", "deviation", "all"])

    own = usable(rows).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
        project, "vec_id bigint, deviation bigint, all array<double>")
    explained = F.array(*[F.lit(e).cast("double") for e in model.explained])
    return own.select("vec_id", "deviation", F.posexplode("all").alias("place", "whitened")).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(table(prepared(spark), sf_dir, "embeddings"))
