"""Time rules: epoch milliseconds, business day, zone shifts.

All of them work on zone-free timestamps, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shopstrata.session import BUSINESS_ZONE


def epoch_ms(utc_ntz: Column) -> Column:
    """Whole milliseconds since 1970 of a zone-free UTC timestamp."""
    since_epoch = utc_ntz - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = since_epoch.cast("interval second").cast("decimal(20,6)")
    return (seconds * 1000).cast("bigint")


def local_to_epoch_ms(local_ntz: Column, zone: str = BUSINESS_ZONE) -> Column:
    """UTC epoch milliseconds of a wall-clock time in `zone`."""
    return epoch_ms(F.convert_timezone(F.lit(zone), F.lit("UTC"), local_ntz))


def epoch_ms_to_local(ms: Column, zone: str = BUSINESS_ZONE) -> Column:
    """Wall-clock time in `zone` of UTC epoch milliseconds."""
    return F.convert_timezone(None, F.lit(zone), F.timestamp_millis(ms).cast("timestamp_ntz"))


def biz_date(ms: Column, zone: str = BUSINESS_ZONE) -> Column:
    return F.to_date(epoch_ms_to_local(ms, zone))


def shift_zone(local_ntz: Column, source: str = "+08:00", target: str = "+00:00") -> Column:
    return F.convert_timezone(F.lit(source), F.lit(target), local_ntz)


def to_precision(ts_ntz: Column, unit: str) -> Column:
    """Drop the digits below `unit` ('SECOND' or 'MILLISECOND')."""
    step = {"SECOND": "1", "MILLISECOND": "0.001"}[unit]
    below = F.extract(F.lit("SECOND"), ts_ntz) % F.lit(step).cast("decimal(8,6)")
    return ts_ntz - F.make_dt_interval(secs=below.cast("decimal(18,6)"))
