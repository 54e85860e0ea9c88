"""The slot calendar and the availability grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger.functions.expressions import FIRST_HOUR, SLOTS_PER_DAY, slot_start_time


def slot_ids(slots: int = SLOTS_PER_DAY) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(slots))).alias("slot_id")


def time_slots(
    spark: SparkSession, open_hour: int = FIRST_HOUR, close_hour: int = 23, step_minutes: int = 60
) -> DataFrame:
    """One row per start time from opening to closing inclusive."""
    slots = max(0, (close_hour - open_hour) * 60 // step_minutes + 1)
    ids = spark.range(1, slots + 1, numPartitions=1).select(F.col("id").cast("int").alias("slot_id"))
    return ids.withColumn("start_time", slot_start_time(F.col("slot_id"), open_hour, step_minutes))


def service_calendar(bookings: DataFrame, slots: int = SLOTS_PER_DAY) -> DataFrame:
    """The slots of every date that has bookings."""
    return bookings.select("service_date").distinct().select("service_date", slot_ids(slots)).withColumn(
        "start_time", slot_start_time(F.col("slot_id"))
    )


def availability_grid(rtables: DataFrame, slots: int = SLOTS_PER_DAY) -> DataFrame:
    """S3: every table vacant in every slot. Exploding a slot array needs no join at all."""
    return rtables.select("table_id", slot_ids(slots)).select(
        "table_id", "slot_id", F.lit(None).cast("bigint").alias("booking_id"), F.lit("vacant").alias("status")
    )


def booked_days_grid(bookings: DataFrame, slots: int = SLOTS_PER_DAY, packed: bool = False) -> DataFrame:
    """The vacant grid of the (table, date) pairs that bookings refer to.

    ``packed`` leaves a day in one row that tells the number of its ``vacant_slots``.
    """
    days = bookings.select("table_id", "service_date").distinct()
    if packed:
        return days.withColumn("vacant_slots", F.lit(slots))
    return days.select("table_id", "service_date", slot_ids(slots)).select(
        "table_id", "service_date", "slot_id",
        F.lit(None).cast("bigint").alias("booking_id"), F.lit("vacant").alias("status"),
    )
