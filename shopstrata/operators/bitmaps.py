"""Exact distinct counts that merge: sets of ids as bitmaps, from minutes to days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shopstrata.functions.numbers import metric
from shopstrata.operators.metrics import ALL

SET, PART = "ids", "id_part"


def id_sets(df: DataFrame, groups: Sequence[Column | str], id: str) -> DataFrame:
    """The distinct ids of each group, as one bitmap for each 32,768 ids in a row (`id_part`). Null ids are in no set.

    Ids are whole numbers. Bitmaps are built before the shuffle, so an id or a group with many rows costs no more than others.
    """
    known = df.filter(F.col(id).isNotNull())
    return known.groupBy(*groups, F.bitmap_bucket_number(id).alias(PART)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id)).alias(SET)
    )


def merged(sets: DataFrame, groups: Sequence[Column | str]) -> DataFrame:
    """Sets of coarser groups: the union of the sets in each."""
    return sets.groupBy(*groups, PART).agg(F.bitmap_or_agg(SET).alias(SET))


def set_sizes(sets: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """The number of ids of each group, as metric rows."""
    sized = sets.groupBy(*groups).agg(metric(F.sum(F.bitmap_count(SET))).alias("metric_value"))
    return sized.select(*groups, F.lit(name).alias("metric_name"), F.lit(ALL).alias("dimension_key"), "metric_value")
