"""All hops of the warehouse over one root folder: raw changes -> detail -> metrics -> results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from shopstrata.functions.times import epoch_ms_to_local
from shopstrata.operators import cleanse, metrics
from shopstrata.schemas import KEYED_TABLES
from shopstrata.streaming import dedup, hops
from shopstrata.streaming.keyed_table import KeyedTable
from shopstrata.streaming.runs import start_hop

Frame = Callable[[], DataFrame]


@dataclass(frozen=True)
class Sources:
    """What the warehouse reads. The first four are streams: nested events and change rows. The others are
    dimensions as they are now, read again for every batch (see `CachedDimension`)."""

    events: Frame
    payments: Frame
    refunds: Frame
    order_lines: Frame
    orders: Frame
    provinces: Frame
    skus: Frame
    categories: Frame


@dataclass(frozen=True)
class Hop:
    stream: Frame
    write: hops.WriteBatch
    recomputes: bool = False


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, sources: Sources):
        self.spark, self.root, self.sources = spark, root.rstrip("/"), sources
        self.tables = {name: KeyedTable.named(spark, self.root, name) for name in KEYED_TABLES}
        self.layers = [self._details(), self._metrics(), self._results()]

    def checkpoint(self, hop: str) -> str:
        return f"{self.root}/checkpoints/{hop}"

    def _details(self) -> dict[str, Hop]:
        def detail(name, source, prepare):
            write = hops.detail_hop(self.tables[name], self.checkpoint(name), prepare, "create_time")
            return Hop(source, write)

        events = "dwd_traffic_event"
        traffic = hops.detail_hop(self.tables[events], self.checkpoint(events), dedup.earliest_changes, moves=False)
        return {
            events: Hop(lambda: cleanse.flatten_events(self.sources.events()), traffic),
            "dwd_payment_detail": detail("dwd_payment_detail", self.sources.payments, cleanse.payment_detail),
            "dwd_refund_detail": detail("dwd_refund_detail", self.sources.refunds, cleanse.refund_detail),
            "dwd_order_detail": detail("dwd_order_detail", self.sources.order_lines, cleanse.order_detail),
        }

    def _metrics(self) -> dict[str, Hop]:
        def day(hop, source, result, compute, names):
            detail = self.tables[source]
            write = hops.day_metric_hop(detail, self.tables[result], self.checkpoint(hop), compute, names)
            return hop, Hop(detail.stream, write, recomputes=True)

        def minute(result, source, compute, time):
            detail = self.tables[source]
            write = hops.minute_metric_hop(detail, self.tables[result], self.checkpoint(result), compute, time)
            return result, Hop(detail.stream, write, recomputes=True)

        event_time = epoch_ms_to_local(F.col("event_time_ms"))

        from_sources = self.sources
        return dict(
            [
                minute("dws_traffic_1m", "dwd_traffic_event", metrics.traffic_minute, event_time),
                minute("dws_trade_1m", "dwd_payment_detail", metrics.trade_minute, F.col("create_time")),
                day("traffic_day", "dwd_traffic_event", "dws_traffic_day", metrics.traffic_day, ["browse_pv", "day_uv"]),
                day("payment_day", "dwd_payment_detail", "dws_trade_day", metrics.payment_day, list(metrics.PAYMENT_DAY)),
                day("refund_day", "dwd_refund_detail", "dws_trade_day", metrics.refund_day, ["refund_amount"]),
                day("order_day", "dwd_order_detail", "dws_trade_day", metrics.order_day, list(metrics.ORDER_DAY)),
                day(
                    "gmv_province",
                    "dwd_payment_detail",
                    "dws_trade_day",
                    lambda paid: metrics.gmv_province(paid, from_sources.orders(), from_sources.provinces()),
                    ["gmv_province"],
                ),
                day(
                    "order_amount_category",
                    "dwd_order_detail",
                    "dws_trade_day",
                    lambda lines: metrics.order_amount_category(lines, from_sources.skus(), from_sources.categories()),
                    ["order_amount_category"],
                ),
            ]
        )

    def _results(self) -> dict[str, Hop]:
        def result(domain):
            source, target = self.tables[f"dws_{domain}"], self.tables[f"ads_{domain}"]
            return f"ads_{domain}", Hop(source.stream, hops.publish_hop(source, target, self.checkpoint(f"ads_{domain}")))

        return dict(result(domain) for domain in ("traffic_1m", "traffic_day", "trade_1m", "trade_day"))

    def _launch(self, name: str, hop: Hop, follow: str | None = None) -> StreamingQuery:
        return start_hop(hop.stream(), hop.write, self.checkpoint(name), follow=follow)

    def run_once(self) -> None:
        """Carry all present input through the layers; hops of a layer run side by side."""
        for layer in self.layers:
            for query in [self._launch(name, hop) for name, hop in layer.items()]:
                query.awaitTermination()

    def start(self, follow: str = "30 seconds", recompute: str = "5 minutes") -> dict[str, StreamingQuery]:
        """Start every hop as its own continuous query. Hops that recompute days or minutes do so every `recompute`."""
        return {
            name: self._launch(name, hop, recompute if hop.recomputes else follow)
            for layer in self.layers
            for name, hop in layer.items()
        }
