"""Keyed upsert tables: an append-only change log in parquet, where the last change of a key wins on read."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shopstrata.operators.cleanse import latest_per_key
from shopstrata.schemas import KEYED_TABLES

LOG, BASE = "log", "base"


def batch_label(hop: str, checkpoint: str, batch_id: int) -> str:
    """A folder name that is the same when a batch is repeated, and new when a hop starts over elsewhere."""
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]
    return f"{hop}-{run}-{batch_id}"


class KeyedTable:
    """Rows by primary key under `path`, in folders kind=log/batch=<label>/<day>=<date>.

    A row carries `op` ('c', 'u', 'd') and `seq`; per key the highest `seq` counts. Writing a batch costs as
    much as the batch, whatever the table holds, and writing it again replaces only its own folder, so
    a repeated batch changes nothing. `day` is the date column the table is partitioned by. A key whose
    day changes needs a 'd' row on its old day; see `route`. `writers` is how many tasks share a day in batches
    of stateful streams, by default as many as the session's shuffle partitions.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], day: str, writers: int | None = None
    ):
        self.spark, self.path, self.keys, self.day = spark, path.rstrip("/"), list(keys), day
        self.writers = writers or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.columns = schema.fieldNames()
        self.log_schema = T.StructType(
            schema.fields
            + [T.StructField("op", T.StringType()), T.StructField("seq", T.LongType())]
            + [T.StructField(name, T.StringType()) for name in ("kind", "batch")]
        )
        empty = spark.createDataFrame([], self.log_schema)
        empty.drop("kind", "batch").write.mode("ignore").partitionBy(day).parquet(f"{self.path}/kind={LOG}/batch=none")
        self.covered_path = f"{self.path}.covered"
        empty.select("kind", "batch").write.mode("ignore").parquet(self.covered_path)

    @classmethod
    def named(cls, spark: SparkSession, root: str, name: str) -> "KeyedTable":
        """One of the declared tables, under `root`."""
        return cls(spark, f"{root}/{name}", *KEYED_TABLES[name])

    def write(self, changes: DataFrame, batch: str, kind: str = LOG) -> None:
        """Write a batch of rows with op and seq.

        With adaptive execution, files are balanced by size and a busy day is split. A stateful stream runs
        without it; there, a day's rows are spread over `writers` tasks by key.
        """
        rows = changes.select(*self.columns, "op", "seq")
        if changes.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            rows = rows.hint("rebalance", self.day)
        else:
            rows = rows.repartition(self.day, F.pmod(F.xxhash64(*self.keys), F.lit(self.writers)))
        rows.write.mode("overwrite").partitionBy(self.day).parquet(f"{self.path}/kind={kind}/batch={batch}")

    def _covered(self) -> list[str]:
        """Batches whose rows a later base holds: those since `retire` was last called."""
        rows = self.spark.read.schema("kind string, batch string").parquet(self.covered_path)
        return [f"{kind}/{batch}" for kind, batch in rows.distinct().collect()]

    def changes(self) -> DataFrame:
        """The newest base and every batch it does not cover; the other folders are pruned."""
        folder = F.concat_ws("/", "kind", "batch")
        return self.spark.read.schema(self.log_schema).parquet(self.path).filter(~folder.isin(self._covered()))

    def stream(self, files_per_batch: int | None = None) -> DataFrame:
        """New changes as a stream. A batch that was written twice shows up twice."""
        reader = self.spark.readStream.schema(self.log_schema).option("ignoreMissingFiles", "true")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.option("basePath", self.path).parquet(f"{self.path}/kind={LOG}/batch=*")

    def latest(self, where: Column | None = None, without_batch: str | None = None, parts: int | None = None) -> DataFrame:
        """The last change per key, deletions included, optionally as if a batch had not been written.

        Each task sorts what it reads and sends on the last change of a key, so a key may have any number of changes. With
        `parts`, rows meet in so many parts before they are sorted: for a table of few changes a key, of which a task then holds
        no more as its files grow.
        """
        log = self.changes()
        if where is not None:
            log = log.filter(where)
        if without_batch is not None:
            log = log.filter(F.col("batch") != without_batch)
        log, keys = log.drop("kind", "batch"), list(dict.fromkeys([self.day, *self.keys]))
        return latest_per_key(log.repartition(parts, *keys) if parts else log, keys, ["seq"])

    def snapshot(self, where: Column | None = None, parts: int | None = None) -> DataFrame:
        """The rows of the table now; `parts` as in `latest`."""
        return self.latest(where, parts=parts).filter(F.col("op") != "d").select(*self.columns)

    def route(self, changes: DataFrame, old_day: Column | None = None) -> DataFrame:
        """Changes plus a deletion on the old day of every key that moved to another day.

        With `old_day` (the day before the change, from the change's old image) this is a local step.
        Without it, the batch is compacted and the old days are looked up in the table.
        """
        if old_day is None:
            current = self.latest().filter(F.col("op") != "d").select(*self.keys, F.col(self.day).alias("_old_day"))
            marked = latest_per_key(changes, self.keys, ["seq"]).join(current, self.keys, "left")
        else:
            marked = changes.withColumn("_old_day", old_day)
        kept = [name for name in self.columns if name != self.day]
        stay = F.struct(F.col(self.day).alias("day"), F.col("op").alias("op"))
        leave = F.struct(F.col("_old_day").alias("day"), F.lit("d").alias("op"))
        known = F.col("_old_day").isNotNull()
        moved = known & ~F.col("_old_day").eqNullSafe(F.col(self.day))
        bare = (F.col("op") == "d") & F.col(self.day).isNull()  # a deletion without an after-image goes to the old day alone
        placed = F.explode(F.when(known & bare, F.array(leave)).when(moved, F.array(stay, leave)).otherwise(F.array(stay)))
        routed = marked.select(*kept, "seq", placed.alias("_placed"))
        return routed.select(*kept, F.col("_placed.day").alias(self.day), F.col("_placed.op").alias("op"), "seq")

    def upsert(self, rows: DataFrame, batch: str, days: Sequence, scope: Column | None = None) -> None:
        """Write the rows that are new or differ from the table. `days` are the days of `rows`; only they are read.

        With `scope`, rows of these days within it that `rows` lacks are deleted. An unchanged row is not
        written again, so its `updated_at` stays.
        """
        read = F.col(self.day).isin(list(days))
        stamped = "updated_at" in self.columns
        values = [name for name in self.columns if name not in self.keys and name != "updated_at"]
        old = self.latest(read if scope is None else read & scope, without_batch=batch).select(
            *self.keys,
            F.struct(*values).alias("_old"),
            (F.col("op") != "d").alias("_live"),
            F.col("seq").alias("_old_seq"),
        )
        new = rows.select(*self.keys, F.struct(*values).alias("_new"))
        both = new.join(old, self.keys, "left" if scope is None else "full_outer")
        live = F.coalesce(F.col("_live"), F.lit(False))
        gone = F.col("_new").isNull()
        differs = F.when(live, ~F.col("_new").eqNullSafe(F.col("_old"))).otherwise(~gone)
        changed = both.filter(differs).select(
            *self.keys,
            *[F.when(gone, F.col(f"_old.{name}")).otherwise(F.col(f"_new.{name}")).alias(name) for name in values],
            *([F.current_timestamp().cast("timestamp_ntz").alias("updated_at")] if stamped else []),
            F.when(gone, "d").otherwise("u").alias("op"),
            (F.coalesce("_old_seq", F.lit(0)) + 1).cast("bigint").alias("seq"),
        )
        self.write(changed, batch)

    def compact(self, batch: str) -> None:
        """Write the last change of every key, deletions included, as one base batch; reads then skip what it covers.

        Only batches that are complete when it starts are covered, and they count as covered once the base is written.
        A label may be used for one base only. One compaction of a table runs at a time.
        """
        seen = self.changes().select("kind", "batch").distinct().collect()
        if not seen:
            return
        folders = [f"{kind}/{label}" for kind, label in seen]
        self.write(self.latest(F.concat_ws("/", "kind", "batch").isin(folders)), batch, kind=BASE)
        covered = self.spark.createDataFrame(seen, "kind string, batch string")
        covered.coalesce(1).write.mode("append").parquet(self.covered_path)

    def retire(self) -> None:
        """Delete the folders of covered batches. Call it when no reader or stream still needs them."""
        for folder in self._covered():
            kind, label = folder.split("/", 1)
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/kind={kind}/batch={label}")
            path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def touched_days(changes: DataFrame, day: str) -> list:
    """The days a batch touches: at most one value per calendar day. Rows without a day count for no metric."""
    return [row[0] for row in changes.select(day).filter(F.col(day).isNotNull()).distinct().collect()]
