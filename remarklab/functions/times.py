"""Time functions; the session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def epoch_to_ts(col: Column) -> Column:
    """Epoch seconds to a timestamp; text that is not a number gives NULL instead of an error."""
    return F.timestamp_seconds(col.try_cast("bigint"))


def epoch_to_text(col: Column) -> Column:
    return F.date_format(epoch_to_ts(col), TIME_TEXT)


def parse_twitter_time(col: Column) -> Column:
    """``Wed Oct 10 20:19:24 +0000 2018`` to a timestamp; the weekday is not parsed."""
    return F.try_to_timestamp(F.substring(col, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))


def year_of(col: Column) -> Column:
    return F.year(col)


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")
