"""The 90-day complaint count, from an event table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.schema import COMPLAINT_DAYS, COMPLAINTS


def complaint_counts(
    events: DataFrame,
    until: datetime,
    days: int = COMPLAINT_DAYS,
    user: str = "user_id",
    time: str = "ts",
    is_complaint: Column | None = None,
) -> DataFrame:
    """(user, NumComplaints90Days) per user with a complaint in the `days` before `until`.

    The filter reaches the scan. Counts form within each task first, so a user who wrote a third of
    all events sends one row per task.
    """
    complaint = F.col("event_type") == "error" if is_complaint is None else is_complaint
    end = F.lit(until.isoformat(sep=" ")).cast("timestamp_ntz")
    start = end - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = events.filter(complaint & (F.col(time) >= start) & (F.col(time) < end))
    return recent.groupBy(user).agg(F.count(F.lit(1)).alias(COMPLAINTS))


def add_complaints(customers: DataFrame, counts: DataFrame, customer_key: str, user: str = "user_id") -> DataFrame:
    """All customers with their complaint count, null without complaints. Keys are compared as text.

    `counts` has one row per user; Spark broadcasts it only if its size is below the session's threshold.
    Beyond, adaptive execution splits a key that fills much of `customers`, but only where both sides of
    the join come straight from an exchange. The second condition, implied by the first, sees to that: the
    counting leaves its rows placed by user alone, which is no placement by both.
    """
    mine, theirs = F.col(customer_key).cast("string"), F.col(user).cast("string")
    same = (mine == theirs) & (F.length(mine) == F.length(theirs))
    return customers.join(counts, same, "left").drop(user)
