"""Time parsing and bucketing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted timestamp layouts and the short window names.
TIMESTAMP_LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")
UNITS = {"s": "second", "min": "minute", "m": "minute", "h": "hour", "d": "day"}


def parse_time(text: Column | str) -> Column:
    """Timestamp from either accepted layout, null when neither fits."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in TIMESTAMP_LAYOUTS])


def time_text(ts: Column | str) -> Column:
    return F.date_format(ts, TIMESTAMP_LAYOUTS[0])


def interval_text(size: str) -> str:
    """'5min' -> '5 minute'; full interval text passes through."""
    short = re.fullmatch(r"\s*(\d+)\s*([a-z]+)\s*", size.lower())
    if short and short.group(2) in UNITS:
        return f"{short.group(1)} {UNITS[short.group(2)]}"
    return size


def bucket_start(ts: Column | str, size: str) -> Column:
    """Start of the tumbling bucket that holds ts."""
    return F.window(ts, interval_text(size))["start"]
