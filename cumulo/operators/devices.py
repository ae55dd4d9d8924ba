"""Per-device and per-user activity aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def events_by_device(events: DataFrame, user: str = "user_id", device: str = "device_id",
                     host: str = "host") -> DataFrame:
    """Per (user, device) the event count and the sorted distinct hosts.

    Rows with a NULL user are dropped (as the reference's source filter).
    The reference's table has the hosts as an array: hosts are a bounded
    domain (the sites one operates).  ``device_counts`` does without.
    """
    return (events.where(F.col(user).isNotNull())
                  .groupBy(user, device)
                  .agg(F.count(F.lit(1)).alias("event_counts"),
                       F.array_sort(F.collect_set(host)).alias("host_array")))


def device_counts(events: DataFrame, user: str = "user_id", device: str = "device_id") -> DataFrame:
    """J17 without the hosts: per (user, device) the event count."""
    return (events.where(F.col(user).isNotNull())
                  .groupBy(user, device).agg(F.count(F.lit(1)).alias("event_counts")))


def user_devices(by_device: DataFrame, user: str = "user_id", device: str = "device_id") -> DataFrame:
    """One row per (user, device), from the J17 aggregate alone.

    ``device_hits`` = events of the device, ``total_hits`` = all events of
    the user, ``max_device_hits`` = events of the busiest device (the
    reference's "total_hits"), ``num_devices`` (known devices; events without
    a device count in the totals only, and are a row with a NULL device).
    The reference joined raw events back to the aggregate, which repeats
    every device once per event of the user (SURVEY §8-Q12), and listed a
    user's devices in one array; rows have the same shape however many
    devices a user has, and no task holds a user's list.

    ``by_device`` is read twice: give it a written table (J17's
    ``events_aggregated_staging``), as the registered query does.
    """
    totals = (by_device.groupBy(user)
                       .agg(F.sum("event_counts").alias("total_hits"),
                            F.max("event_counts").alias("max_device_hits"),
                            F.count(device).alias("num_devices")))
    return (by_device.select(user, device, F.col("event_counts").alias("device_hits"))
                     .join(totals, user)
                     .select(user, device, "device_hits", "total_hits", "max_device_hits", "num_devices"))
