"""The windowed activity measures on a stream: re-sent events dropped, counts by account and sliding window, late events by watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import at_night, instant


def fresh(events: DataFrame, key: str = "event_id", ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Each key once, as long as it is re-sent within the delay."""
    return events.withColumn(ts, instant(F.col(ts))).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def activity(events: DataFrame, account: str = "user_id", ts: str = "ts", amount: str = "value", length: str = "7 days", slide: str = "1 day") -> DataFrame:
    """(account, window_start, window_end, txns, amount, night): the batch measures by sliding window; needs a watermark on a stream."""
    grouped = events.groupBy(account, F.window(ts, length, slide).alias("w"))
    out = grouped.agg(F.count("*").alias("txns"), F.sum(amount).alias("amount"), F.count_if(at_night(F.col(ts))).alias("night"))
    return out.select(account, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "txns", "amount", "night")
