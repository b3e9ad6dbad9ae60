"""The event id rule."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def event_id(
    biz_date: Column, seq: Column, uid: Column, ts: Column, action_id: Column, page_id: Column, item: Column
) -> Column:
    """md5 over the seven fields joined by '|'. A missing item counts as the text None."""
    # Separator and the text of a missing item.
    separator, missing_item = "|", "None"
    parts = [biz_date, seq, uid, ts, action_id, page_id]
    return F.md5(
        F.concat_ws(
            separator,
            *[part.cast("string") for part in parts],
            F.coalesce(item.cast("string"), F.lit(missing_item)),
        )
    )
