"""Tables of vectors: rows as whole numbers, and exact totals of them over all tasks."""

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# The largest number of single precision. Components beyond it count as not finite.
LARGEST = float(np.finfo(np.float32).max)
LONG = 2 ** 63 - 1
# Totals are sent as digits to the base 2^60, whose sums over all tasks are decimals.
DIGIT = 60


def usable(rows: DataFrame) -> DataFrame:
    """The rows whose embedding is there and has only finite components. Empty ones have none that are not."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > LARGEST))
    return rows.where(F.col("embedding").isNotNull()).where(~bad)


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Lists of numbers as rows of doubles, shorter ones filled up with zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0)) if width is None else width
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), scale a power of two: as int64 where that holds them with room, else as Python's whole numbers."""
    scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) < 2.0 ** 61:
        return scaled.astype(np.int64)
    out = np.empty(scaled.shape, object)
    out.ravel()[:] = [int(v) for v in scaled.ravel().tolist()]
    return out


def exact_sum(values: np.ndarray) -> np.ndarray:
    """Sums of the columns as Python's whole numbers."""
    if values.dtype == object:
        return values.sum(axis=0) if len(values) else np.zeros(values.shape[1], object)
    high, low = values >> 32, values & 0xFFFFFFFF
    return high.sum(axis=0).astype(object) * 2 ** 32 + low.sum(axis=0).astype(object)


def most(values: np.ndarray) -> int:
    """The largest absolute value."""
    return max(int(values.max()), -int(values.min())) if values.size else 0


def totals(rows: DataFrame, terms: Callable[[pa.RecordBatch], Iterable[tuple[int, np.ndarray]]]) -> dict[int, int]:
    """Adds up whole numbers by slot over all rows, exactly, whatever their size.

    `terms` gives for a batch (first slot, values for this and the following slots). A task adds up its batches and
    sends a row a slot. There are as many slots as the model has numbers, which does not grow with the rows.
    """
    def add(batches):
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for first, values in terms(batch):
                now = own.get(first)
                if now is not None and len(now) < len(values):
                    now = np.concatenate([now, np.zeros(len(values) - len(now), object)])
                if now is None:
                    now = np.zeros(len(values), object)
                now[:len(values)] += values
                own[first] = now
        rows_ = [(first + k, *d) for first, values in own.items() for k, v in enumerate(values) for d in digits(int(v))]
        columns = list(zip(*rows_)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "place", "digit"])

    sent = rows.mapInArrow(add, "slot bigint, place bigint, digit bigint")
    added = sent.groupBy("slot", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit"))
    out: dict[int, int] = {}
    for r in added.collect():
        out[r["slot"]] = out.get(r["slot"], 0) + (int(r["digit"]) << DIGIT * r["place"])
    return out


def digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) of a whole number; the last digit has its sign."""
    out = []
    while not -2 ** DIGIT <= value < 2 ** DIGIT:
        out.append((len(out), value & (2 ** DIGIT - 1)))
        value >>= DIGIT
    return [*out, (len(out), value)]
