"""Metrics kept up to date by signed changes: a batch costs what it touches, not what its days hold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from shopstrata.operators import retraction
from shopstrata.operators.cleanse import latest_per_key
from shopstrata.operators.metrics import ALL, Agg, closed_windows
from shopstrata.schemas import DAY_KEY, DAY_METRIC, MINUTE_KEY, MINUTE_METRIC
from shopstrata.streaming.hops import WriteBatch
from shopstrata.streaming.keyed_table import KeyedTable, batch_label

BUCKET = "bucket"


def _with(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(name, kind) for name, kind in columns.items()])


class SignedMetrics:
    """Sums, row counts and distinct counts of keyed rows by day, or by day and minute, under inserts, updates and deletions.

    Three keyed tables under `root`: `rows`, the last change of each key; `values`, how many rows have each value of a
    distinct metric; `totals`, the metrics. The first two lie in `buckets` folders by a hash of their key, and a batch reads the folders
    and keys it touches alone; of the metrics it reads the days it touches. Every table is written under the label of the batch
    and read without it, so repeating a batch changes nothing, and nor does a change that comes again in a later batch.

    `where` picks the rows that count, `time` is the column that dates them. `dimension` is a column to break the metrics down by; a row
    without it counts nowhere. It is kept with the row, so what is taken back later is what was counted, even
    if a lookup would give another value by then.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        keys: Sequence[str],
        specs: Mapping[str, Agg],
        where: Column | str,
        time: str = "create_time",
        minutes: bool = False,
        dimension: str | None = None,
        buckets: int = 8,
    ):
        self.specs, self.where, self.time, self.keys, self.buckets = dict(specs), where, time, list(keys), buckets
        self.columns = schema.fieldNames()
        self.groups = {"metric_date": F.to_date(time)}
        if minutes:
            self.groups["window_start"] = F.window(time, "1 minute").getField("start")
        if dimension is not None:
            self.groups["dimension_key"] = F.col(dimension)
        value_key = [*self.groups, "metric_name", "value"]
        metric, metric_key = (MINUTE_METRIC, MINUTE_KEY) if minutes else (DAY_METRIC, DAY_KEY)
        group_fields = [metric[name] for name in self.groups]
        long, text, number = T.LongType(), T.StringType(), T.IntegerType()
        value_schema = _with(T.StructType(group_fields), metric_name=text, value=text, n=long, bucket=number)
        self.rows = KeyedTable(spark, f"{root}/rows", _with(schema, bucket=number), keys, BUCKET)
        self.values = KeyedTable(spark, f"{root}/values", value_schema, value_key, BUCKET)
        self.totals = KeyedTable(spark, f"{root}/totals", _with(metric, n_rows=long, bucket=number), metric_key, BUCKET)
        self.metric_columns = metric.fieldNames()

    def _bucket(self, keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def _known(self, table: KeyedTable, touched: DataFrame, buckets: list[int], label: str) -> DataFrame:
        """The last change of the keys in `touched`, one row each, as before the batch."""
        log = table.changes().filter(F.col(BUCKET).isin(buckets) & (F.col("batch") != label)).drop("kind", "batch")
        return latest_per_key(log.join(touched.select(*table.keys), table.keys, "left_semi"), table.keys, ["seq"])

    def hop(self, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] = lambda changes: changes) -> WriteBatch:
        """For `foreachBatch` over change rows: columns, op ('c', 'u', 'd') and seq. Deletions need no more than the key."""

        def write(batch: DataFrame, batch_id: int) -> None:
            label = batch_label("signed", checkpoint, batch_id)
            changes = prepare(batch).select(*self.columns, "op", "seq", self._bucket(self.keys))
            changes = latest_per_key(changes, self.keys, ["seq"]).persist()
            (buckets,) = changes.agg(F.collect_set(BUCKET)).first()  # at most `buckets`
            known = self._known(self.rows, changes, buckets, label)
            net = retraction.net_changes(changes, known, self.keys, self.columns).persist()
            try:
                self._write(net, label)
            finally:
                changes.unpersist()
                net.unpersist()

        return write

    def _write(self, net: DataFrame, label: str) -> None:
        rest = [name for name in self.columns if name not in self.keys]
        rows = net.withColumn("_image", F.coalesce("new", "old")).select(
            *self.keys,
            *[F.col(f"_image.{name}").alias(name) for name in rest],
            self._bucket(self.keys),
            F.when(F.col("new").isNull(), "d").otherwise("u").alias("op"),
            "seq",
        )
        groups, keys = list(self.groups), [*self.groups, "metric_name"]
        signed = retraction.counted(retraction.weighted(net), self.groups, self.where)
        moves = retraction.total_changes(signed, groups, self.specs).persist()
        deltas = retraction.value_changes(signed, groups, self.specs).withColumn(BUCKET, self._bucket(self.values.keys)).persist()
        distinct = any(spec.kind == "distinct" for spec in self.specs.values())
        of_days = moves.select("metric_date", self._bucket(["metric_date"]).alias("_of_day"))
        places = of_days.unionByName(deltas.select(BUCKET), allowMissingColumns=True) if distinct else of_days.withColumn(BUCKET, F.lit(None))
        side_by_side = inheritable_thread_target(net.sparkSession)
        with ThreadPoolExecutor(2) as pool:  # the tables are written side by side, as none reads another
            jobs = [pool.submit(side_by_side(self.rows.write), rows, label)]
            touched = places.agg(  # bounds and folders
                F.min("metric_date").alias("first_day"),
                F.max("metric_date").alias("last_day"),
                F.collect_set("_of_day").alias("of_days"),
                F.collect_set(BUCKET).alias("of_values"),
            ).first()
            summed, steps = moves, None
            if distinct:
                steps = retraction.stepped(deltas, self._known(self.values, deltas, touched.of_values, label), self.values.keys).persist()
                values = steps.withColumn("op", F.when(F.col("n") == 0, "d").otherwise("u"))
                jobs.append(pool.submit(side_by_side(self.values.write), values, label))
                counts = steps.filter("step <> 0").select(
                    *keys, F.lit(0).cast("bigint").alias("n_rows"), F.col("step").cast("decimal(18,2)").alias("metric_value")
                )
                summed = moves.unionByName(counts)
            summed = summed.groupBy(*keys).agg(F.sum("metric_value").alias("_change"), F.sum("n_rows").alias("_rows"))
            self.totals.write(self._added(summed.filter("_change <> 0 OR _rows <> 0"), touched, label), label)
            for job in jobs:
                job.result()
        for frame in (moves, deltas, steps):
            if frame is not None:
                frame.unpersist()

    def _added(self, summed: DataFrame, touched: Row, label: str) -> DataFrame:
        """The changed metrics with their changes; one without rows is deleted. Read are the folders and the span of the touched days."""
        keys = [*self.groups, "metric_name"]
        near = F.col(BUCKET).isin(touched.of_days) & F.col("metric_date").between(F.lit(touched.first_day), F.lit(touched.last_day))
        known = self.totals.latest(near, without_batch=label)
        known = known.select(*keys, "metric_value", "n_rows", F.col("seq").alias("_seq"))
        rows = F.col("_rows") + F.coalesce("n_rows", F.lit(0))
        return summed.join(known, keys, "left").select(
            *keys,
            *([] if "dimension_key" in keys else [F.lit(ALL).alias("dimension_key")]),
            (F.col("_change") + F.coalesce("metric_value", F.lit(0))).cast("decimal(18,2)").alias("metric_value"),
            rows.alias("n_rows"),
            self._bucket(["metric_date"]),
            F.when(rows == 0, "d").otherwise("u").alias("op"),
            (F.coalesce("_seq", F.lit(0)) + 1).alias("seq"),
        )

    def metrics(self) -> DataFrame:
        """The metrics now, of open windows too."""
        return self.totals.snapshot().select(*self.metric_columns)

    def closed(self) -> DataFrame:
        """The minutes that the latest time ever sent has closed, on rows that are gone or do not count as well."""
        return closed_windows(self.metrics(), self.rows.changes().agg(F.max(self.time)))
