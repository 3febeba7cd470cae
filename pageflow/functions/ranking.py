"""Top-k rows per group, and ranked rows folded into an ordered array."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(rows: DataFrame, keys: list, order: list, k: int) -> DataFrame:
    """The first `k` rows of each group with their rank `rn`.

    Spark plans the filter on row_number as a group limit on both sides of the shuffle, so a
    task sends at most k rows per group and a hot group never meets in one place.
    """
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("rn") <= k)


def in_rank_order(value: Column, when: Column | None = None) -> Column:
    """Aggregate: the group's values as an array ordered by `rn`, NULL if there are none."""
    entry = F.struct(F.col("rn"), value.alias("value"))
    entries = F.sort_array(F.collect_list(entry if when is None else F.when(when, entry)))
    return F.when(F.size(entries) > 0, F.transform(entries, lambda e: e["value"]))
