"""Table availability over a (table, service date) grid.

The grid is never materialised for the search. A table's day is one 64-bit mask, and
"vacant in every slot of the interval" is ``mask & wanted == 0``. The answer depends only
on (restaurant, date, start, duration), so tables are matched against the distinct shapes
of the requests, at most slots * (slots + 1) / 2 per restaurant and date, never against
every request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatledger.functions.expressions import MAX_MASK_SLOTS, SLOTS_PER_DAY, slot_fits, slot_mask

SHAPE = ["restaurant_id", "service_date", "start_time_slot", "booking_duration"]


def occupancy_masks(bookings: DataFrame, slots: int = SLOTS_PER_DAY) -> DataFrame:
    """Occupied slots per (table, date) from bookings that hold a table.

    Slots past closing do not exist, so an overrunning booking only blocks the rest of
    the day. ``bit_or`` combines on the map side.
    """
    if slots > MAX_MASK_SLOTS:
        raise ValueError(f"at most {MAX_MASK_SLOTS} slots per day fit a mask")
    day = F.lit((1 << slots) - 1)
    start, duration = F.col("start_time_slot"), F.col("booking_duration")
    held = F.least(duration, F.lit(slots))
    return (
        bookings.where((start >= 1) & (start <= slots) & (duration >= 1))
        .groupBy("table_id", "service_date")
        .agg(F.bit_or(slot_mask(start, held).bitwiseAND(day)).alias("occupied_mask"))
    )


def grid_masks(grid: DataFrame) -> DataFrame:
    """Occupied slots per (table, date) from grid cells; reads the status, not the booking id."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot_id") - 1).cast("int"))
    return (
        grid.where(F.col("status") == "occupied")
        .groupBy("table_id", "service_date")
        .agg(F.bit_or(bit).alias("occupied_mask"))
    )


def available_tables(
    requests: DataFrame, rtables: DataFrame, masks: DataFrame, slots: int = SLOTS_PER_DAY
) -> DataFrame:
    """Every table that could take a request shape, for each distinct shape asked for."""
    start, duration = F.col("start_time_slot"), F.col("booking_duration")
    shapes = requests.select(*SHAPE).where(slot_fits(start, duration, slots)).distinct()
    tables = rtables.select("restaurant_id", "table_id")
    return (
        shapes.join(tables, "restaurant_id")
        .join(masks, ["table_id", "service_date"], "left")
        .where(
            F.coalesce(F.col("occupied_mask"), F.lit(0)).bitwiseAND(slot_mask(start, duration)) == 0
        )
        .select(*SHAPE, "table_id")
    )


def find_available_table(
    requests: DataFrame, rtables: DataFrame, masks: DataFrame, slots: int = SLOTS_PER_DAY
) -> DataFrame:
    """R2: the lowest free table per request, NULL when none; requests are independent what-ifs."""
    first = (
        available_tables(requests, rtables, masks, slots)
        .groupBy(*SHAPE)
        .agg(
            F.min("table_id").alias("table_id"),
            F.count(F.lit(1)).cast("bigint").alias("available_count"),
        )
    )
    return requests.join(first, SHAPE, "left").withColumn(
        "available_count", F.coalesce("available_count", F.lit(0).cast("bigint"))
    )
