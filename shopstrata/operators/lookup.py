"""Dimension lookups and metrics over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def lookup(
    fact: DataFrame, dim: DataFrame, on: str, dim_key: str = "id", cols: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Widen `fact` by `cols` of the dimension row with `dim_key` equal to `on`. Unmatched facts drop (inner).

    No broadcast hint: Spark broadcasts the dimension when its size is under
    spark.sql.autoBroadcastJoinThreshold and joins by shuffle, splitting skewed partitions, above it.
    """
    narrow = dim.select(F.col(dim_key).alias("_dim_key"), *cols)
    return fact.join(narrow, fact[on] == F.col("_dim_key"), how).drop("_dim_key")


def preaggregate(fact: DataFrame, by: Sequence[Column | str], sums: Mapping[str, Column]) -> DataFrame:
    """Sums per lookup key before the lookup.

    A sum by dimension attribute equals the sum of per-key sums, so the join only sees one row per key and
    no key is hot in it; the reduction runs before the shuffle.
    """
    return fact.groupBy(*by).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
