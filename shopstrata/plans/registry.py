"""Every query by name: (spark, folder of parquet tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from shopstrata.functions.event_keys import event_id
from shopstrata.functions.times import biz_date, epoch_ms_to_local, local_to_epoch_ms
from shopstrata.operators import bitmaps, changes, cleanse, metrics, quality, sequence
from shopstrata.plans import marts, serving
from shopstrata.schemas import DAY_KEY, DAY_METRIC, KEYED_TABLES, MINUTE_KEY, MINUTE_METRIC, ORDER_LINE, PAYMENT_DETAIL, REFUND_DETAIL, TRAFFIC_DETAIL
from shopstrata.session import run_dir
from shopstrata.sources import manifest, readers, retail
from shopstrata.sources.change_log import read_change_log
from shopstrata.sources.retail import BROWSE, PAID, PURCHASE, REFUNDED, table
from shopstrata.streaming import dedup, hops, replay
from shopstrata.streaming.dedup import expiring_state
from shopstrata.streaming.dimensions import KeyCache, looked_up
from shopstrata.streaming.incremental import SignedMetrics
from shopstrata.streaming.keyed_table import KeyedTable, touched_days
from shopstrata.streaming.runs import run_hop, run_to_table, start_hop, stop_hop, wait_for_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Roles.


def _events(spark, d):
    return table(spark, d, "events")


def _traffic(spark, d):
    return retail.traffic_detail(_events(spark, d))


def _payments(spark, d):
    return retail.payments(table(spark, d, "orders"))


def _lines(spark, d):
    return retail.order_lines(table(spark, d, "lineitem"))


def _refunds(spark, d):
    return retail.refunds(table(spark, d, "lineitem"))


def _users(spark, d):
    return retail.user_dim(table(spark, d, "customer"))


def _provinces(spark, d):
    return retail.province_dim(table(spark, d, "nation"))


def _skus(spark, d):
    return retail.sku_dim(table(spark, d, "part"))


def _categories(spark, d):
    return retail.category_dim(table(spark, d, "part"))


# Cleansing.

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query
def dedup_keep_earliest(spark, d):
    return cleanse.dedup_earliest(table(spark, d, "lineitem"), LINE_KEY, LINE_ORDER)


@query
def latest_per_key(spark, d):
    return cleanse.latest_per_key(table(spark, d, "lineitem"), LINE_KEY, LINE_ORDER)


@query
def flatten_event_json(spark, d):
    nested = retail.nested_events(_events(spark, d))
    return cleanse.flatten_events(readers.decode_events(readers.encode_events(nested)))


@query
def payment_detail(spark, d):
    raw = retail.purchases(_events(spark, d))
    return cleanse.payment_detail(
        raw.withColumn("payment_type", F.lit("card"))
        .withColumn("trade_no", F.md5(F.col("id").cast("string")))
        .withColumn("callback_time", F.col("create_time") + F.expr("INTERVAL '1.5' SECOND"))
    )


@query
def refund_detail(spark, d):
    """The supplier plays the user, which refunds of the test tables lack."""
    lines = table(spark, d, "lineitem")
    own = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return cleanse.refund_detail(retail.refunds(lines, own.alias("id"), F.col("l_suppkey").alias("user_id")))


@query
def order_detail(spark, d):
    raw = _lines(spark, d).withColumn("id", F.col("order_id") * 10 + F.col("line_number"))
    return cleanse.order_detail(raw.withColumn("sku_name", F.concat(F.lit("sku "), F.col("sku_id").cast("string"))))


@query
def narrow_scan(spark, d):
    return _traffic(spark, d).select("uid", "action_id", F.col("biz_date").cast("string").alias("biz_date"), "event_id")


@query
def source_count(spark, d):
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("row_count"))


@query
def json_round_trip(spark, d):
    payments = _payments(spark, d).withColumn("create_time", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss"))
    records = payments.select(
        F.to_json(F.struct("id")).alias("key"),
        F.to_json(F.struct(*payments.columns)).alias("value"),
        F.col("id").alias("offset"),
    )
    value = StructType([field for field in PAYMENT_DETAIL if field.name in payments.columns])
    return readers.decode_keyed(records, StructType([PAYMENT_DETAIL["id"]]), value)


@query
def event_id_md5(spark, d):
    flat = cleanse.flatten_events(retail.nested_events(_events(spark, d)))
    # A launch or a browse has no item.
    item = F.when(~F.col("action_id").isin("launch", "browse"), F.col("item"))
    hashed = event_id(
        F.col("biz_date"), F.col("event_id"), F.col("uid"), F.col("ts"), F.col("action_id"), F.col("page_id"), item
    )
    return flat.select(F.col("event_id").alias("seq"), hashed.alias("event_id"))


@query
def normalize_event_time(spark, d):
    ts = F.col("ts")
    local_ms, utc_ms = local_to_epoch_ms(ts), local_to_epoch_ms(ts, "UTC")
    return _events(spark, d).select(
        "event_id",
        local_ms.alias("local_event_time_ms"),
        biz_date(local_ms).alias("local_biz_date"),
        utc_ms.alias("utc_event_time_ms"),
        biz_date(utc_ms).alias("utc_biz_date"),
    )


@query
def resequence_events(spark, d):
    lines = table(spark, d, "lineitem").select(*LINE_KEY, *LINE_ORDER)
    return sequence.resequence(lines, LINE_KEY, LINE_ORDER, ["l_shipdate", *LINE_KEY])


# Day and minute metrics.


@query
def traffic_day(spark, d):
    return metrics.traffic_day(_traffic(spark, d), BROWSE)


@query
def traffic_minute_pv_uv(spark, d):
    return metrics.traffic_minute(_traffic(spark, d), BROWSE)


@query
def trade_day(spark, d):
    return metrics.trade_day(_payments(spark, d), _refunds(spark, d), _lines(spark, d), PAID, REFUNDED)


@query
def trade_minute_gmv(spark, d):
    return metrics.trade_minute(retail.purchases(_events(spark, d)), PURCHASE)


@query
def gmv_by_nation(spark, d):
    return metrics.gmv_province(_payments(spark, d), _users(spark, d), _provinces(spark, d), PAID, order_key="user_id")


@query
def order_amount_by_category(spark, d):
    return metrics.order_amount_category(_lines(spark, d), _skus(spark, d), _categories(spark, d))


@query
def traffic_minute_stream(spark, d):
    detail = retail.traffic_detail(retail.table_stream(spark, d, "events"))
    return run_to_table(metrics.traffic_minute(detail, BROWSE), "traffic-minute")


@query
def trade_minute_stream(spark, d):
    events = retail.table_stream(spark, d, "events").filter(F.col("event_type") == PURCHASE)
    return run_to_table(metrics.trade_minute(retail.purchases(events), PURCHASE), "trade-minute")


def _repeated(nested):
    """Every event twice, the copy five seconds late."""
    late = F.explode(F.array(F.lit(0), F.lit(5000)))
    return nested.select("*", late.alias("late")).withColumn("event_time_ms", F.col("event_time_ms") + F.col("late"))


@query
def ttl_dedup(spark, d):
    """Repeated events through expiring state."""
    nested = _repeated(retail.nested_events(retail.table_stream(spark, d, "events")))
    groups = max(8, _events(spark, d).count() // 500)
    with expiring_state(spark):
        emitted = run_to_table(dedup.ttl_dedup(cleanse.flatten_events(nested), groups=groups), "ttl-dedup")
    return changes.apply_changes(emitted, ["event_id", "biz_date"])


@query
def watermark_dedup_stream(spark, d):
    """Repeated events through state that expires with event time, in the JVM."""
    flat = cleanse.flatten_events(_repeated(retail.nested_events(retail.table_stream(spark, d, "events"))))
    timed = flat.withColumn("event_time", F.timestamp_millis("event_time_ms"))
    emitted = run_to_table(dedup.watermark_dedup(timed, "event_time"), "watermark-dedup")
    return changes.apply_changes(emitted, ["event_id"])


@query
def traffic_detail_stream(spark, d):
    """Repeated events as a stream into the keyed detail table."""
    nested = _repeated(retail.nested_events(retail.table_stream(spark, d, "events")))
    flat = cleanse.flatten_events(nested).withColumn("event_time", F.timestamp_millis("event_time_ms"))
    folder = run_dir(spark, "traffic-detail")
    detail = KeyedTable(spark, f"{folder}/table", TRAFFIC_DETAIL, ["event_id"], "biz_date")
    write = hops.detail_hop(detail, f"{folder}/checkpoint", moves=False)
    run_hop(dedup.daily_dedup(flat, "event_time"), write, f"{folder}/checkpoint", "update")
    return detail.snapshot()


@query
def traffic_minute_chain_stream(spark, d):
    """Repeated events as a stream into the keyed detail table, and from there into minutes."""
    flat = cleanse.flatten_events(_repeated(retail.nested_events(retail.table_stream(spark, d, "events"))))
    folder = run_dir(spark, "traffic-minute-chain")
    detail = KeyedTable(spark, f"{folder}/detail", TRAFFIC_DETAIL, ["event_id"], "biz_date")
    result = KeyedTable(spark, f"{folder}/minutes", MINUTE_METRIC, MINUTE_KEY, "metric_date")
    checkpoints = f"{folder}/detail-checkpoint", f"{folder}/minute-checkpoint"
    run_hop(flat, hops.detail_hop(detail, checkpoints[0], dedup.earliest_changes, moves=False), checkpoints[0])
    time = epoch_ms_to_local(F.col("event_time_ms"))
    run_hop(detail.stream(), hops.minute_metric_hop(detail, result, checkpoints[1], metrics.traffic_minute, time), checkpoints[1])
    return result.snapshot()


def _signed_payments(spark, folder, names, minutes=False):
    """Payment metrics kept up to date by signed changes, in new tables under `folder`."""
    columns = ["id", "order_id", "user_id", "payment_amount", "payment_status", "create_time"]
    schema = StructType([PAYMENT_DETAIL[name] for name in columns])
    specs = {name: metrics.PAYMENT_DAY[name] for name in names}
    return SignedMetrics(spark, folder, schema, ["id"], specs, F.col("payment_status") == "SUCCESS", minutes=minutes)


@query
def trade_minute_chain_stream(spark, d):
    """Payment changes in batches that follow no time order, as signed changes into minutes.

    Purchases are created pending and paid by an update in the batch after, clicks are created paid, views are created
    paid and deleted in the batch after by a record without values, all others stay pending.
    """
    payments = retail.purchases(_events(spark, d))
    kind = F.col("payment_status")
    first = F.pmod(F.xxhash64("id"), F.lit(2))
    status = F.when(kind.isin("click", "view"), "SUCCESS").otherwise("PENDING")
    created = F.struct(F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"), first.alias("part"), status.alias("status"))

    def after(op):
        return F.struct(F.lit(op).alias("op"), F.lit(2).cast("bigint").alias("seq"), (first + 1).alias("part"), F.lit("SUCCESS").alias("status"))

    history = (
        F.when(kind == "purchase", F.array(created, after("u")))
        .when(kind == "view", F.array(created, after("d")))
        .otherwise(F.array(created))
    )
    valued = F.col("change.op") != "d"
    log = payments.withColumn("change", F.explode(history)).select(
        "id",
        *[F.when(valued, F.col(name)).alias(name) for name in ("order_id", "user_id", "payment_amount")],
        F.when(valued, F.col("change.status")).alias("payment_status"),
        F.when(valued, F.col("create_time")).alias("create_time"),
        "change.op",
        "change.seq",
        "change.part",
    )
    folder = run_dir(spark, "trade-minute-chain")
    signed = _signed_payments(spark, f"{folder}/signed", ["gmv", "payment_order_count"], minutes=True)
    arrived = log.drop("part")
    for part in range(3):
        log.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{folder}/in")
        changed = spark.readStream.schema(arrived.schema).parquet(f"{folder}/in")
        run_hop(changed, signed.hop(f"{folder}/checkpoint"), f"{folder}/checkpoint")
    return signed.closed()


@query
def trade_day_stream(spark, d):
    """Payment changes as a stream, as signed changes into daily metrics.

    Purchases are paid, clicks are paid a day after they are created, views are paid and then deleted.
    """
    events = retail.purchases(retail.table_stream(spark, d, "events"))
    kind, next_day = F.col("payment_status"), F.col("create_time") + F.expr("INTERVAL 1 DAY")

    def change(op, seq, status, time, before):
        image = F.struct(F.lit(status).alias("payment_status"), time.alias("create_time"))
        before = F.struct(before.alias("create_time"))
        return F.struct(F.lit(op).alias("op"), F.lit(seq).cast("bigint").alias("seq"), image.alias("row"), before.alias("before"))

    created, nothing = F.col("create_time"), F.lit(None).cast("timestamp_ntz")
    history = (
        F.when(kind == "purchase", F.array(change("c", 1, "SUCCESS", created, nothing)))
        .when(
            kind == "click",
            F.array(change("c", 1, "PENDING", created, nothing), change("u", 2, "SUCCESS", next_day, created)),
        )
        .when(
            kind == "view",
            F.array(change("c", 1, "SUCCESS", created, nothing), change("d", 2, "SUCCESS", created, created)),
        )
    )
    log = events.withColumn("change", F.explode(history)).select(
        "id", "order_id", "user_id", "payment_amount", "change.row.*", "change.op", "change.seq", "change.before"
    )
    folder = run_dir(spark, "trade-day")
    signed = _signed_payments(spark, f"{folder}/signed", list(metrics.PAYMENT_DAY))
    run_hop(log.drop("before"), signed.hop(f"{folder}/checkpoint"), f"{folder}/checkpoint")
    return signed.metrics()


# Time order.


@query
def ordered_replay_stream(spark, d):
    """Purchases in no order, sorted into numbered files and sent file by file: no minute is lost."""
    bought = retail.purchases(_events(spark, d).filter(F.col("event_type") == PURCHASE)).repartition(4, "user_id")
    folder = run_dir(spark, "ordered-replay")
    schema = replay.write_in_order(bought, ["id"], ["create_time"], ["create_time", "id"], folder, 4)
    ordered = replay.read_in_order(spark, folder, schema, f"{folder}/progress", files_per_batch=2)
    minutes, _ = replay.run_batches_to_table(metrics.trade_minute(ordered, PURCHASE), "ordered-minutes")
    return minutes


@query
def late_rows_stream(spark, d):
    """Events in three batches by their number: the rows of each that come behind the minutes closed by those before."""
    folder = run_dir(spark, "late-rows")
    events = _events(spark, d).select("event_id", "ts")
    found = replay.late_table(spark, f"{folder}/late")
    write = replay.late_rows_hop(found, f"{folder}/checkpoint", "ts")
    for part in range(3):
        events.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{folder}/in")
        run_hop(spark.readStream.schema(events.schema).parquet(f"{folder}/in"), write, f"{folder}/checkpoint")
    return found.snapshot().drop("part")


# Breakdowns of a stream, through cached lookups.


def _broken_down(spark, batches, schema, spec, where, dimension, caches, purpose):
    """A metric by a looked-up name, kept up to date by the change rows of each of `batches`."""
    folder = run_dir(spark, purpose)
    columns = StructType([*schema, StructField(dimension, StringType())])
    signed = SignedMetrics(spark, f"{folder}/signed", columns, ["id"], spec, where, dimension=dimension)
    lookups = [(on, KeyCache(spark, f"{folder}/{on}", read, names)) for on, read, names in caches]
    write = signed.hop(f"{folder}/checkpoint", lambda rows: looked_up(rows, lookups).withColumnRenamed("name", dimension))
    for batch in batches:
        batch.write.mode("append").parquet(f"{folder}/in")
        run_hop(spark.readStream.schema(batch.schema).parquet(f"{folder}/in"), write, f"{folder}/checkpoint")
    return signed.metrics()


def _change(rows, op, seq):
    return rows.select("*", F.lit(op).alias("op"), F.lit(seq).cast("bigint").alias("seq"))


@query
def gmv_province_stream(spark, d):
    """Every payment arrives as paid; a second batch gives each its stored status, which takes many back."""
    stored = _payments(spark, d).select("id", "user_id", "payment_amount", "payment_status", "create_time")
    first = _change(stored.withColumn("payment_status", F.lit(PAID)), "c", 1)
    second = _change(stored.filter(F.col("payment_status") != PAID), "u", 2)
    caches = [("user_id", lambda: _users(spark, d), ["province_id"]), ("province_id", lambda: _provinces(spark, d), ["name"])]
    spec = {"gmv_province": metrics.total("payment_amount")}
    return _broken_down(spark, [first, second], stored.schema, spec, F.col("payment_status") == PAID, "province", caches, "gmv-province")


@query
def order_amount_category_stream(spark, d):
    """Order lines arrive; a second batch adds a piece to every first line and deletes every sixth."""
    lines = retail.order_lines(_unique_lines(spark, d))
    stored = lines.select(
        (F.col("order_id") * 10 + F.col("line_number")).alias("id"), "sku_id", "create_time", "order_price", "sku_num",
        (F.col("order_price") * F.col("sku_num")).cast("decimal(18,2)").alias("line_amount"),
    )
    number, more = F.col("id") % 10, F.col("line_amount") + F.col("order_price")
    added = _change(stored.filter(number == 1).withColumn("line_amount", more.cast("decimal(18,2)")), "u", 2)
    second = added.unionByName(_change(stored.filter(number == 6), "d", 2))
    caches = [
        ("sku_id", lambda: _skus(spark, d), ["category_id"]),
        ("category_id", lambda: _categories(spark, d), ["name"]),
    ]
    spec, kept = {"order_amount_category": metrics.total("line_amount")}, ["id", "sku_id", "create_time", "line_amount"]
    schema = StructType([stored.schema[name] for name in kept])
    return _broken_down(spark, [_change(stored, "c", 1), second], schema, spec, F.lit(True), "category", caches, "order-amount-category")


# A snapshot, then its change log.


#: Rows of a file of a snapshot or log, about: what one task writes, and later reads.
FILE_ROWS = 250_000


def _files(rows):
    return max(4, -(-rows.count() // FILE_ROWS))


def _from_log(spark, detail, as_of, current, later, purpose, prepare, stopped=False):
    """Detail rows from a table's snapshot and log, read to the end; or two files at a time, stopped on the way and resumed.

    `current` is the table as of number `as_of`, in a partition for each file of the snapshot; `later` gives the changes above
    of the snapshot as it is stored. The log also repeats the creation of every row of the snapshot, which the stream has to
    leave out. Both have more files, not larger ones, as the table grows.
    """
    folder = run_dir(spark, purpose)
    current.write.parquet(f"{folder}/in/snapshot")
    stored = spark.read.schema(current.schema).parquet(f"{folder}/in/snapshot")
    created = stored.select(F.lit("c").alias("op"), F.pmod(F.xxhash64("id"), F.lit(as_of)).alias("seq"), *stored.columns)
    log = created.unionByName(later(stored).select(created.columns))
    log.repartitionByRange(_files(log), "seq").sortWithinPartitions("seq").write.parquet(f"{folder}/in/log")
    table = KeyedTable(spark, f"{folder}/table", StructType([*detail, StructField("bucket", IntegerType())]), ["id"], "bucket")
    write = hops.keyed_detail_hop(table, f"{folder}/checkpoint", prepare)
    if stopped:
        stream = read_change_log(spark, f"{folder}/in", current.schema, as_of, files_per_batch=2, progress=f"{folder}/progress")
        started = start_hop(stream, write, f"{folder}/checkpoint", follow="0 seconds")
        wait_for_batches(started, 2)
        stop_hop(started, spark)
    run_hop(read_change_log(spark, f"{folder}/in", current.schema, as_of), write, f"{folder}/checkpoint")
    return table.snapshot(parts=_files(table.changes())).drop("bucket")


AS_OF = 1_000_000


def _unique_lines(spark, d):
    """One row for each line number of an order, of which the test table repeats some.

    Lines meet before they are sorted, in parts whose number grows with the table; ranked where they are read, a task sorts a
    whole split.
    """
    lines = table(spark, d, "lineitem")
    return cleanse.dedup_earliest(lines.repartition(_files(lines), *LINE_KEY), LINE_KEY, LINE_ORDER)


def _later(current, op, number, where, **new):
    """Changes above the snapshot's number, one of each row that `where` picks."""
    seq = F.lit(AS_OF) + F.lit(number) * F.lit(10**10) + F.col("id")
    changed = current.filter(where).withColumns({name: column.cast(current.schema[name].dataType) for name, column in new.items()})
    return changed.select(F.lit(op).alias("op"), seq.cast("bigint").alias("seq"), *current.columns)


@query
def payment_log_stream(spark, d):
    """Payments as of a number; then open ones are paid a day later, and low-priority paid ones are deleted."""
    names = ["id", "order_id", "user_id", "payment_type", "payment_amount", "payment_status", "create_time"]
    payments = _payments(spark, d)
    paid = payments.repartition(_files(payments)).select(*names[:4], F.md5(F.col("id").cast("string")).alias("trade_no"), *names[4:])
    current = paid.withColumn("callback_time", F.col("create_time") + F.expr("INTERVAL '1.5' SECOND"))

    def later(stored):
        a_day_later = F.col("create_time") + F.expr("INTERVAL 1 DAY")
        paid = _later(stored, "u", 1, F.col("payment_status") == "P", payment_status=F.lit(PAID), create_time=a_day_later)
        gone = _later(stored, "d", 2, (F.col("payment_status") == PAID) & (F.col("payment_type") == "5-LOW"))
        return paid.unionByName(gone)

    return _from_log(spark, PAYMENT_DETAIL, AS_OF, current, later, "payment-log", cleanse.payment_detail, stopped=True)


@query
def refund_log_stream(spark, d):
    """Refunds as of a number; then those asked for are granted."""
    lines = _unique_lines(spark, d)
    own = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    current = retail.refunds(lines, own.alias("id"), F.col("l_suppkey").alias("user_id")).filter(F.col("refund_status") != "N")

    def later(stored):
        return _later(stored, "u", 1, F.col("refund_status") == "A", refund_status=F.lit(REFUNDED))

    return _from_log(spark, REFUND_DETAIL, AS_OF, current, later, "refund-log", cleanse.refund_detail)


@query
def order_log_stream(spark, d):
    """Order lines as of a number; then every first line has one piece more, every sixth line is deleted and comes back a unit dearer."""
    lines = retail.order_lines(_unique_lines(spark, d))
    current = lines.withColumn("id", F.col("order_id") * 10 + F.col("line_number")).drop("line_number")
    current = current.withColumn("sku_name", F.concat(F.lit("sku "), F.col("sku_id").cast("string")))
    number = F.col("id") % 10

    def later(stored):
        more = _later(stored, "u", 1, number == 1, sku_num=F.col("sku_num") + 1)
        gone = _later(stored, "d", 1, number == 6)
        back = _later(stored, "c", 2, number == 6, order_price=F.col("order_price") + 1)
        return more.unionByName(gone).unionByName(back)

    return _from_log(spark, ORDER_LINE, AS_OF, current, later, "order-log", cleanse.order_detail)


@query
def default_dimension(spark, d):
    keyed = _payments(spark, d).withColumn("priority", F.nullif(F.col("payment_type"), F.lit("4-NOT SPECIFIED")))
    by_priority = metrics.day_metrics(
        keyed, F.to_date("create_time"), {"placed_orders": metrics.rows()}, dimension="priority"
    )
    return metrics.with_default_dimension(by_priority)


# Keyed changes.


def _payment_changes(spark, d):
    """A change log over payments: every payment is created, a 'P' one is then paid a day later, a low-priority
    paid one is deleted."""
    paid_later = F.struct(
        F.lit("u").alias("op"),
        F.lit(2).cast("bigint").alias("seq"),
        F.lit(PAID).alias("payment_status"),
        (F.col("create_time") + F.expr("INTERVAL 1 DAY")).alias("create_time"),
    )
    created = F.struct(F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"), "payment_status", "create_time")
    deleted = F.struct(F.lit("d").alias("op"), F.lit(3).cast("bigint").alias("seq"), "payment_status", "create_time")
    history = (
        F.when(F.col("payment_status") == "P", F.array(created, paid_later))
        .when((F.col("payment_status") == PAID) & (F.col("payment_type") == "5-LOW"), F.array(created, deleted))
        .otherwise(F.array(created))
    )
    log = _payments(spark, d).select(
        "id", "order_id", "user_id", "payment_amount", F.explode(history).alias("change")
    )
    return log.select("id", "order_id", "user_id", "payment_amount", "change.*")


@query
def apply_changes(spark, d):
    return changes.apply_changes(_payment_changes(spark, d), ["id"])


@query
def changed_payment_day(spark, d):
    return metrics.payment_day(changes.apply_changes(_payment_changes(spark, d), ["id"]), PAID)


@query
def upsert_partial_columns(spark, d):
    orders = _payments(spark, d).select("id", "payment_status", "payment_amount", "create_time")
    known = orders.filter(F.col("payment_status").isin("F", "O"))
    given = orders.filter(F.col("payment_status").isin("O", "P")).select(
        "id",
        F.lit("PAID").alias("payment_status"),
        (F.col("payment_amount") + 1).cast("decimal(16,2)").alias("payment_amount"),
        (F.col("create_time") + F.expr("INTERVAL 1 DAY")).alias("create_time"),
    )
    return changes.upsert(known, given, ["id"], ["payment_status", "payment_amount"])


@query
def upsert_partial_log(spark, d):
    """Partial upserts of orders as a stored log: all but open ones inserted, then open and pending ones sent with status and amount
    to set, then pending ones with the time alone."""
    orders = _payments(spark, d).select("id", "payment_status", "payment_amount", "create_time")
    day_later = (F.col("create_time") + F.expr("INTERVAL 1 DAY")).alias("create_time")
    more = (F.col("payment_amount") + 1).cast("decimal(16,2)").alias("payment_amount")

    def sent(seq, statuses, mask, *columns):
        rows = orders.filter(F.col("payment_status").isin(*statuses)).select("id", *columns)
        return rows.select("*", F.array(*map(F.lit, mask)).alias("mask"), F.lit(seq).alias("seq"))

    columns = ["payment_status", "payment_amount", "create_time"]
    log = [
        sent(1, ["F", "P"], columns, *columns),
        sent(2, ["O", "P"], ["payment_status", "payment_amount"], F.lit("PAID").alias("payment_status"), more, day_later),
        sent(3, ["P"], ["create_time"], F.lit("LOST").alias("payment_status"), more, (F.col("create_time") + F.expr("INTERVAL 2 DAY")).alias("create_time")),
    ]
    folder = run_dir(spark, "partial-log")
    for batch in log:
        batch.write.mode("append").parquet(folder)
    return changes.merge_partial(spark.read.schema(log[0].schema).parquet(folder), ["id"], columns)


@query
def keyed_update(spark, d):
    orders = _payments(spark, d).select("id", "user_id", "payment_status", F.col("create_time").alias("operate_time"))
    returned = _refunds(spark, d).filter(F.col("refund_status") == REFUNDED)
    updates = returned.groupBy(F.col("order_id").alias("id")).agg(F.max("create_time").alias("operate_time"))
    return changes.update_by_key(orders, updates.withColumn("payment_status", F.lit("REFUNDED")), ["id"])


@query
def publish_result(spark, d):
    return changes.publish(trade_minute_gmv(spark, d))


@query
def publish_stream(spark, d):
    """Daily metrics published, computed again without every hundredth user, and published again: the result, and which rows were
    written a second time. The others keep their `updated_at`."""
    bought = retail.purchases(_events(spark, d))
    folder = run_dir(spark, "publish")
    day = KeyedTable(spark, f"{folder}/day", DAY_METRIC, DAY_KEY, "metric_date")
    result = KeyedTable(spark, f"{folder}/result", *KEYED_TABLES["ads_trade_day"])
    write = hops.publish_hop(day, result, f"{folder}/checkpoint")
    for k, rows in enumerate([bought, bought.filter(F.col("user_id") % 100 != 0)]):
        found = metrics.payment_day(rows, PURCHASE).persist()
        day.upsert(found, f"batch-{k}", touched_days(found, "metric_date"), F.lit(True))
        found.unpersist()
        run_hop(day.stream(), write, f"{folder}/checkpoint")
    first = result.changes().groupBy(*DAY_KEY).agg(F.min("updated_at").alias("_first"))
    again = (F.col("updated_at") > F.col("_first")).alias("rewritten")
    return result.snapshot().join(first, DAY_KEY).select(*DAY_KEY, "metric_value", again)


# Audits.

AUDITED = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": LINE_KEY,
    "events": ["event_id"],
}


@query
def row_count_audit(spark, d):
    return quality.row_counts({name: table(spark, d, name) for name in AUDITED})


@query
def manifest_check(spark, d):
    tables = {name: table(spark, d, name) for name in AUDITED}
    per_key = [quality.key_completeness(name, tables[name], key) for name, key in AUDITED.items()]
    expected = quality.union_checks(*per_key).select("table_name", F.col("key_count").alias("expected"))
    return quality.manifest_check(tables, expected)


@query
def orphan_audit(spark, d):
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    every = F.lit(True)
    of_orders = {
        "detail_without_order": (every, every),
        "refund_without_order": (F.col("l_returnflag") == REFUNDED, every),
        "detail_without_payment": (every, F.col("o_orderstatus") == PAID),
    }
    return quality.union_checks(
        quality.orphans("order_without_user", orders, "o_custkey", customer, "c_custkey"),
        quality.orphans("user_without_province", customer, "c_nationkey", nation, "n_nationkey"),
        quality.orphans("detail_without_sku", lines, "l_partkey", table(spark, d, "part"), "p_partkey"),
        quality.orphans_by_condition(lines, "l_orderkey", orders, "o_orderkey", of_orders),
    )


@query
def status_distribution(spark, d):
    return quality.amount_by(
        _payments(spark, d), F.col("payment_status").alias("order_status"), "order_count", "payment_amount", "total_amount"
    )


@query
def paid_day_baseline(spark, d):
    paid = _payments(spark, d).filter(F.col("payment_status") == PAID)
    day = F.to_date("create_time").alias("pay_date")
    return quality.amount_by(paid, day, "paid_order_count", "payment_amount", "gmv")


@query
def refund_day_baseline(spark, d):
    back = _refunds(spark, d).filter(F.col("refund_status") == REFUNDED)
    day = F.to_date("create_time").alias("refund_date")
    return quality.amount_by(back, day, "refund_count", "refund_amount", "refund_amount")


@query
def watermark_range(spark, d):
    times = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return quality.watermark_range({name: (table(spark, d, name), time) for name, time in times.items()})


@query
def empty_source_sentinel(spark, d):
    orders = table(spark, d, "orders")
    return quality.empty_source_sentinel(
        {
            "orders": (orders, "o_orderkey"),
            "cancelled_orders": (orders.filter(F.col("o_orderstatus") == "C"), "o_orderkey"),
            "lineitem": (table(spark, d, "lineitem"), "l_linenumber"),
            "events": (_events(spark, d), "event_id"),
        }
    )


@query
def join_hit_counts(spark, d):
    orders, lines, part = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "part")
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    return quality.union_checks(
        quality.join_hits("user_hit_province", customer, "c_nationkey", nation, "n_nationkey"),
        quality.join_hits("detail_hit_sku", lines, "l_partkey", part, "p_partkey"),
        quality.join_hits("sku_hit_category", part, "p_type", _categories(spark, d), "id"),
        quality.join_hits("payment_hit_user", orders, "o_custkey", customer, "c_custkey"),
        quality.join_hits("order_hit_detail", orders, "o_orderkey", lines, "l_orderkey"),
    )


@query
def rollup_equality(spark, d):
    all_days = metrics.union_metrics(
        metrics.payment_day(_payments(spark, d), PAID, ["gmv"]),
        metrics.order_day(_lines(spark, d), ["order_gmv"]),
        gmv_by_nation(spark, d),
        order_amount_by_category(spark, d),
    )
    return quality.rollup_check(all_days, {"gmv_province": "gmv", "order_amount_category": "order_gmv"})


def _latest_event(spark, d):
    return _events(spark, d).agg(F.max("ts"))


@query
def minute_vs_day_gap(spark, d):
    minutes = metrics.closed_windows(traffic_minute_pv_uv(spark, d), _latest_event(spark, d))
    return quality.minute_day_gap(minutes, traffic_day(spark, d))


@query
def uv_le_pv(spark, d):
    return quality.uv_le_pv(traffic_minute_pv_uv(spark, d))


@query
def recon_batch_stream(spark, d):
    keys = ["metric_date", "window_start", "metric_name", "dimension_key"]
    return quality.reconcile(traffic_minute_pv_uv(spark, d), traffic_minute_stream(spark, d), keys)


@query
def monotone_time_check(spark, d):
    orders, events = table(spark, d, "orders"), _events(spark, d)
    return quality.union_checks(
        sequence.time_order_check(events, "event_id", "ts").select(F.lit("events").alias("table_name"), "*"),
        sequence.time_order_check(orders, "o_orderkey", "o_orderdate").select(F.lit("orders").alias("table_name"), "*"),
    )


@query
def key_completeness(spark, d):
    return quality.union_checks(
        quality.key_completeness("events", _events(spark, d), ["event_id"]),
        quality.key_completeness("orders", table(spark, d, "orders"), ["o_orderkey"]),
        quality.key_completeness("lineitem", table(spark, d, "lineitem"), LINE_KEY),
    )


@query
def replay_hash(spark, d):
    """Two replays of the payments' changes: once, and with the paid ones sent again."""
    log = _payments(spark, d).drop("payment_type").select("*", F.lit("c").alias("op"), F.lit(1).cast("bigint").alias("seq"))
    again = log.filter(F.col("payment_status") == PAID).unionByName(log)
    replays = [changes.apply_changes(sent, ["id"]) for sent in (log, again)]
    hashes = [quality.content_hash(rows).withColumn("run", F.lit(run)) for run, rows in enumerate(replays, 1)]
    return hashes[0].unionByName(hashes[1])


@query
def copy_manifest_check(spark, d):
    """Each table's copy, its rows and key range counted file by file, against the manifest taken from the footers when it was written."""
    folder, checks = run_dir(spark, "copies"), []
    for name, key in AUDITED.items():
        copy = f"{folder}/{name}"
        table(spark, d, name).write.parquet(copy)
        noted = manifest.file_manifest(spark, copy, key[0])
        noted.coalesce(1).write.parquet(f"{folder}/manifests/{name}")
        kept = spark.read.schema(manifest.SCHEMA).parquet(f"{folder}/manifests/{name}")
        checks.append(manifest.audit(name, spark.read.parquet(copy), key[0], kept))
    return quality.union_checks(*checks)


@query
def stored_replay_hash(spark, d):
    """Two runs of the payments' changes into tables of their own: one straight through, one a file at a time, stopped, resumed and
    sent the paid ones again. The hashes are those of the stored tables."""
    folder = run_dir(spark, "replays")
    log = _change(_payments(spark, d).drop("payment_type"), "c", 1)
    for k in range(2):
        log.repartition(2, "id").write.parquet(f"{folder}/in-{k}")

    def run(k, stopped):
        checkpoint = f"{folder}/checkpoint-{k}"
        schema = StructType([*log.drop("op", "seq").schema, StructField("bucket", IntegerType())])
        stored = KeyedTable(spark, f"{folder}/table-{k}", schema, ["id"], "bucket")
        write = hops.keyed_detail_hop(stored, checkpoint)
        reader = spark.readStream.schema(log.schema)
        if stopped:
            started = start_hop(reader.option("maxFilesPerTrigger", 1).parquet(f"{folder}/in-{k}"), write, checkpoint, follow="0 seconds")
            wait_for_batches(started, 1)
            stop_hop(started, spark)
            log.filter(F.col("payment_status") == PAID).write.mode("append").parquet(f"{folder}/in-{k}")
        run_hop(reader.parquet(f"{folder}/in-{k}"), write, checkpoint)
        return quality.content_hash(stored.snapshot().drop("bucket")).withColumn("run", F.lit(k + 1))

    return run(0, stopped=False).unionByName(run(1, stopped=True))


@query
def sequence_gaps(spark, d):
    """The event ids that are not purchases, as runs between those that are: a lost head and inner gaps of their numbers."""
    return sequence.sequence_gaps(_events(spark, d).filter(F.col("event_type") == PURCHASE), "event_id")


@query
def uv_from_minutes(spark, d):
    """Daily visitors merged from minutes. Every third event comes late, and the minutes it touches replace what was stored."""
    browsed = _traffic(spark, d).filter(F.col("action_id") == BROWSE)
    minute = F.window(epoch_ms_to_local(F.col("event_time_ms")), "1 minute").getField("start")
    browsed = browsed.select("uid", F.col("event_id").cast("bigint").alias("number"), F.col("biz_date").alias("metric_date"), minute.alias("window_start"))
    late = F.col("number") % 3 == 0
    keys = ["metric_date", "window_start"]
    schema = StructType([*MINUTE_METRIC.fields[:2], StructField(bitmaps.PART, LongType()), StructField(bitmaps.SET, BinaryType())])
    stored = KeyedTable(spark, f"{run_dir(spark, 'uv-minutes')}/minutes", schema, [*keys, bitmaps.PART], "metric_date")
    touched = browsed.filter(late).select(*keys).distinct()
    for seq, rows in enumerate([browsed.filter(~late), browsed.join(touched, keys, "left_semi")], 1):
        sets = bitmaps.id_sets(rows, keys, "uid")
        stored.write(sets.select("*", F.lit("u").alias("op"), F.lit(seq).cast("bigint").alias("seq")), f"batch-{seq}")
    return bitmaps.set_sizes(bitmaps.merged(stored.snapshot(), ["metric_date"]), ["metric_date"], "day_uv")


# Marts.


@query
def gmv_day(spark, d):
    return marts.gmv_day(_payments(spark, d), PAID)


@query
def trade_refund(spark, d):
    return marts.trade_refund(_payments(spark, d), _refunds(spark, d), PAID, REFUNDED)


@query
def sku_topn(spark, d):
    return marts.sku_topn(
        _lines(spark, d), _refunds(spark, d), _skus(spark, d), _categories(spark, d), refunded=REFUNDED
    )


@query
def area_stats(spark, d):
    orders = _payments(spark, d).select("order_id", "user_id")
    return marts.area_stats(
        _payments(spark, d), _refunds(spark, d), orders, _users(spark, d), _provinces(spark, d), PAID, REFUNDED
    )


@query
def user_stats(spark, d):
    return marts.user_stats(_payments(spark, d), _refunds(spark, d), PAID, REFUNDED)


@query
def flow_funnel(spark, d):
    stages = {"launch": "signup", "browse": "view", "click": "click", "pay": "purchase"}
    rates = {"click_rate": ("click", "browse"), "pay_rate": ("pay", "click")}
    return marts.flow_funnel(_traffic(spark, d), stages, rates)


@query
def flow_funnel_stages(spark, d):
    """The funnel in all its stages: an error plays the cart, every purchase is an order, one with an even number is paid."""
    kind = F.col("action_id")
    paid = F.when(F.col("event_id").cast("bigint") % 2 == 0, F.array(F.lit("order"), F.lit("pay"))).otherwise(F.array(F.lit("order")))
    plays = {"signup": "launch", "view": "browse", "click": "click", "error": "add_cart"}
    actions = F.when(kind == PURCHASE, paid)
    for stored, stage in plays.items():
        actions = actions.when(kind == stored, F.array(F.lit(stage)))
    return marts.flow_funnel(_traffic(spark, d).withColumn("action_id", F.explode(actions)))


@query
def user_retention(spark, d):
    return marts.user_retention(_traffic(spark, d))


# Serving.


def _minutes(spark, d):
    return metrics.union_metrics(traffic_minute_pv_uv(spark, d), trade_minute_gmv(spark, d))


@query
def latest_cards(spark, d):
    paid = metrics.payment_day(_payments(spark, d), PAID)
    return serving.latest_cards(metrics.union_metrics(paid, traffic_day(spark, d)))


@query
def published_cards(spark, d):
    """The cards read from published tables, of their latest day alone."""
    folder, shown = run_dir(spark, "published"), []
    bought = metrics.payment_day(retail.purchases(_events(spark, d)), PURCHASE)
    for name, rows in (("ads_trade_day", bought), ("ads_traffic_day", traffic_day(spark, d))):
        result = KeyedTable.named(spark, folder, name)
        rows = changes.publish(rows).persist()
        result.upsert(rows, "all", touched_days(rows, "metric_date"))
        rows.unpersist()
        shown.append(serving.published(result).drop("updated_at"))
    return serving.latest_cards(metrics.union_metrics(*shown))


@query
def refund_total(spark, d):
    return serving.refund_total(metrics.refund_day(_refunds(spark, d), REFUNDED))


@query
def minute_series_utc(spark, d):
    return serving.minute_series(_minutes(spark, d), ["browse_pv", "browse_uv", "gmv"])


@query
def minute_series_range(spark, d):
    """The series a dashboard asks for with a time range, both ends included."""
    shown = ["browse_pv", "browse_uv", "gmv"]
    return serving.minute_series(_minutes(spark, d), shown, "2024-01-10 00:00:00", "2024-01-12 12:30:00")


@query
def detail_last_3_days(spark, d):
    trade = metrics.union_metrics(trade_day(spark, d), gmv_by_nation(spark, d), order_amount_by_category(spark, d))
    return serving.recent_detail(trade, traffic_day(spark, d))


@query
def province_breakdown(spark, d):
    found = metrics.province_recompute(_payments(spark, d), _users(spark, d), _provinces(spark, d), PAID, "user_id")
    return serving.by_value(found)


@query
def category_breakdown(spark, d):
    return serving.by_value(metrics.category_recompute(_lines(spark, d), _skus(spark, d), _categories(spark, d)))
