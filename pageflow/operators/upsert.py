"""Keyed tables: of several rows with one key the latest counts."""

from pyspark.sql import DataFrame, functions as F


def latest(rows: DataFrame, keys: list, order: list) -> DataFrame:
    """One row per key, the one greatest in `order`; rows equal in that by their values.

    The aggregate combines before the shuffle, so many versions of one key do not meet, and each column is in it once.
    """
    values = [c for c in rows.columns if c not in keys]
    if not values:
        return rows.distinct()
    newest = F.max(F.struct(*order, *[v for v in values if v not in order]))
    return rows.groupBy(*keys).agg(newest.alias("newest")).select(
        *[c if c in keys else f"newest.{c}" for c in rows.columns])


def upsert(target: DataFrame, batch: DataFrame, keys: list, order_col: str | None = None) -> DataFrame:
    """`target` with the rows of `batch` put in by key; of equally late rows the batch's counts.

    Without `order_col` the batch always counts.
    """
    merged = target.withColumn("arrival", F.lit(0)).unionByName(batch.withColumn("arrival", F.lit(1)))
    order = ["arrival"] if order_col is None else [order_col, "arrival"]
    return latest(merged, keys, order).drop("arrival")
