"""Joins whose key may be hot."""

from pyspark.sql import Column, DataFrame, functions as F


def spread_join(rows: DataFrame, keyed: DataFrame, on: list, piece: Column) -> DataFrame:
    """Inner join of many `rows` to few `keyed` rows, with a column `piece`, dealt by key and piece.

    Nothing is copied beforehand. Adaptive execution sends `keyed` to all tasks if it measures it small, and else splits the
    partitions of hot keys, which it may because the result is dealt anew: an aggregation by key and piece then finds
    a hot key's rows in as many tasks as it has pieces. Only rows that found a partner are dealt again.
    """
    return rows.join(keyed, on).withColumn("piece", piece).repartition(*on, "piece")
