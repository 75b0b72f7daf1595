"""Load times and the snapshot names made from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def load_time(load_ts: dt.datetime | str | Column | None = None) -> Column:
    """Zone-less load time: the given one, or one ``now`` for the whole statement."""
    if load_ts is None:
        return F.localtimestamp()
    if isinstance(load_ts, Column):
        return load_ts.cast("timestamp_ntz")
    return F.lit(str(load_ts)).cast("timestamp_ntz")


def iso_text(ts: Column | str) -> Column:
    """ISO-8601 text; a zero fraction is left out."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")


def snapshot_name(entity: str | Column, ts: Column | str) -> Column:
    """``<entity>_<timestamp>.json``, with the colons that file systems refuse replaced."""
    entity = F.lit(entity) if isinstance(entity, str) else entity
    return F.concat(entity, F.lit("_"), F.translate(iso_text(ts), ":", "-"), F.lit(".json"))


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def folder_stamp(ts: dt.datetime) -> str:
    return ts.isoformat().replace(":", "-")
