"""Dimensions for lookups inside `foreachBatch`, re-read by age."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


class CachedDimension:
    """A dimension kept in executor memory, and on disk beyond it, for `ttl_seconds`: the longest a change of it may
    go unseen."""

    def __init__(
        self,
        read: Callable[[], DataFrame],
        ttl_seconds: float = 30 * 60,
        clock: Callable[[], float] = time.monotonic,
    ):
        self.read, self.ttl, self.clock = read, ttl_seconds, clock
        self.frame: DataFrame | None = None
        self.read_at = 0.0

    def get(self) -> DataFrame:
        if self.frame is not None and self.clock() - self.read_at < self.ttl:
            return self.frame
        if self.frame is not None:
            self.frame.unpersist()
        self.frame, self.read_at = self.read().persist(), self.clock()
        return self.frame


#: Keys that are sent to the dimension's scan as a filter; more of them are joined.
PUSHED = 1000


class KeyCache:
    """Rows of a dimension by key, fetched when a batch first asks for them and kept for `ttl_seconds`.

    Only keys that are missing or too old go to the dimension: few of them as a filter its scan can skip files by, many as a
    join. A key without a row is remembered as such. The cache is a table under `folder`, of at most `most` keys;
    beyond that the oldest go, and are fetched again when asked for. A new cache starts empty.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        read: Callable[[], DataFrame],
        columns: Sequence[str],
        key: str = "id",
        ttl_seconds: float = 30 * 60,
        most: int = 10_000_000,
        clock: Callable[[], float] = time.time,
    ):
        self.spark, self.folder, self.read, self.columns, self.key = spark, folder.rstrip("/"), read, list(columns), key
        self.ttl, self.most, self.clock = ttl_seconds, most, clock
        source = read().schema
        self.schema = T.StructType(
            [source[key], T.StructField("row", T.StructType([source[name] for name in columns])), T.StructField("read_at", T.DoubleType())]
        )
        self.table = spark.createDataFrame([], self.schema)
        self.turn = 0

    def get(self, keys: DataFrame) -> DataFrame:
        """The dimension rows, `key` and columns, for the one column of `keys`."""
        asked = keys.select(F.col(keys.columns[0]).alias(self.key)).dropna().distinct().persist()
        fresh = self.table.filter(F.col("read_at") > self.clock() - self.ttl)
        missing = asked.join(fresh, self.key, "left_anti").persist()
        count = missing.count()
        if count:
            found = self._fetch(missing, count).select(self.key, F.struct(*self.columns).alias("row"))
            entries = missing.join(found, self.key, "left").withColumn("read_at", F.lit(float(self.clock())))
            known = self._kept(fresh.unionByName(entries))
        else:
            known = self.table
        missing.unpersist()
        rows = known.filter("row IS NOT NULL").join(asked, self.key, "left_semi")
        asked.unpersist()
        return rows.select(self.key, "row.*")

    def _fetch(self, missing: DataFrame, count: int) -> DataFrame:
        dimension = self.read().select(self.key, *self.columns)
        if count > PUSHED:
            return dimension.join(missing, self.key, "left_semi")
        return dimension.filter(F.col(self.key).isin([row[0] for row in missing.collect()]))

    def _written(self, entries: DataFrame) -> DataFrame:
        """The next state of the cache, beside the present one."""
        self.turn += 1
        place = f"{self.folder}/state-{self.turn % 2}"
        entries.write.mode("overwrite").parquet(place)
        return self.spark.read.schema(self.schema).parquet(place)

    def _kept(self, entries: DataFrame) -> DataFrame:
        """All entries, for this batch; the newest stay for the next."""
        every = self._written(entries)
        self.table = every
        if every.count() > self.most:
            self.table = self._written(every.orderBy(F.desc("read_at"), self.key).limit(self.most))
        return every


def looked_up(rows: DataFrame, hops: Sequence[tuple[str, KeyCache]]) -> DataFrame:
    """`rows` widened by a chain of lookups: each hop names the column that holds its key. A key without a row gives nulls."""

    def widen(wide: DataFrame, hop: tuple[str, KeyCache]) -> DataFrame:
        on, cache = hop
        found = cache.get(wide.select(on)).withColumnRenamed(cache.key, "_key")
        return wide.join(found, wide[on] == found["_key"], "left").drop("_key")

    return reduce(widen, hops, rows)
