"""Exact first-come-first-served allocation for a batch of booking requests.

Requests are ordered by (ts, request_id). Two things couple them: tables run out per
(restaurant, date), and a member who gets a booking is refused further ones.

Bounded groups. Within one batch a table never becomes free again, so of the ungated
requests with the same (restaurant, date, start, duration) only the first ``n`` can
succeed, ``n`` being the restaurant's table count: each success takes a different table.
Cutting every shape to its first ``n`` requests is therefore exact, and the sequential
scan sees at most shapes * n requests per (restaurant, date) however many were made.

Member gate. Starting from "nobody is gated", allocate, take each member's earliest
success, gate that member's later requests, and repeat until no request's gate changes.
After round k the first k requests of the global order are final, because a request's gate
and its restaurant's state depend only on earlier requests, so the loop ends, and a round
that changes no gate satisfies the sequential rule for every request.

Rounds work on changes alone. A round looks at the requests of members whose first success
moved, scans the (restaurant, date) pairs where that moved a gate, and appends what it found
under its number; nothing written is written again. A pair's bookings are those of the last
round that scanned it, and the versions are merged once, after the last round.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatledger.functions.expressions import SLOTS_PER_DAY, slot_fits, slot_mask
from seatledger.operators.availability import SHAPE
from seatledger.session import scratch_path, stored

DAY = ["restaurant_id", "service_date"]


def _first_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan sorted rows; per day the table rows come first, then the requests in order.

    Tables only fill up, so the search for an interval resumes where its last one ended.
    """
    day, tables, taken, resume = None, [], [], {}
    for batch in batches:
        accepted_ids, accepted_tables = [], []
        rows = zip(*(batch.column(i).to_pylist() for i in range(5)))
        for restaurant, date, table, mask, request in rows:
            if day != (restaurant, date):
                day, tables, taken, resume = (restaurant, date), [], [], {}
            if request is None:
                tables.append(table)
                taken.append(mask)
                continue
            i = resume.get(mask, 0)
            while i < len(taken) and taken[i] & mask:
                i += 1
            resume[mask] = i
            if i < len(taken):
                taken[i] |= mask
                accepted_ids.append(request)
                accepted_tables.append(tables[i])
        yield pa.RecordBatch.from_arrays(
            [pa.array(accepted_ids, pa.int64()), pa.array(accepted_tables, pa.int64())],
            names=["request_id", "table_id"],
        )


class _Versions:
    """Rows of several rounds below one shared folder, each round written once."""

    def __init__(self, rows: DataFrame, name: str):
        self._spark, self._folder, self._rounds = rows.sparkSession, scratch_path(rows.sparkSession, name), 0
        self.schema = rows.schema
        self.append(rows)

    def append(self, rows: DataFrame) -> None:
        rows.select(*self.schema.names).write.parquet(f"{self._folder}/_round={self._rounds}")
        self._rounds += 1

    def rows(self) -> DataFrame:
        """All rounds so far, with the number of each row's in ``_round``."""
        kinds = T.StructType([*self.schema.fields, T.StructField("_round", T.IntegerType())])
        return self._spark.read.schema(kinds).parquet(self._folder)


def _leading_per_shape(requests: DataFrame, salts: int, widest: int) -> DataFrame:
    """The first ``table_count`` requests of every shape.

    ``widest``, the largest table count, is a literal bound that lets Spark trim each input
    partition before the shuffle; the salt keeps what is left of a hot shape from meeting
    in one task before the exact cut.
    """
    order = ["ts", "request_id"]
    salted = Window.partitionBy(*SHAPE, "_salt").orderBy(*order)
    whole = Window.partitionBy(*SHAPE).orderBy(*order)
    return (
        requests.withColumn("_salt", F.pmod(F.xxhash64("request_id"), F.lit(salts)))
        .withColumn("_rank", F.row_number().over(salted))
        .where(F.col("_rank") <= widest)
        .withColumn("_rank", F.row_number().over(whole))
        .where(F.col("_rank") <= widest)
        .where("_rank <= table_count")
        .drop("_salt", "_rank")
    )


def allocate_bookings(
    requests: DataFrame,
    rtables: DataFrame,
    masks: DataFrame,
    open_bookings: DataFrame,
    gate: Sequence[str] = ("member_id",),
    slots: int = SLOTS_PER_DAY,
) -> DataFrame:
    """Decide every request: ``confirmed`` with a table, ``has_open_booking`` or ``no_table``.

    ``masks`` is the occupancy before the batch, ``open_bookings`` the bookings that
    already gate their member: an open booking anywhere refuses the request. With
    ``gate=("member_id", "service_date")`` only one of the same date does. The rounds run
    when this is called, not when the result is read.
    """
    spark = requests.sparkSession
    gate = list(gate)
    if not set(gate) <= {"member_id", "service_date"}:
        raise ValueError("the gate is made of member_id and service_date")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    start, duration = F.col("start_time_slot"), F.col("booking_duration")

    held = open_bookings.groupBy(*gate).agg(F.min("booking_id").alias("held_booking"))
    batch = requests.join(held, gate, "left")

    table_count = rtables.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("table_count"))
    widest = table_count.agg(F.max("table_count")).first()[0] or 0
    live = stored(
        batch.where(F.col("held_booking").isNull() & slot_fits(start, duration, slots))
        .join(table_count, "restaurant_id")
        .select("request_id", "ts", "member_id", *SHAPE, "table_count"),
        "live",
    )
    day_tables = stored(
        live.select(*DAY).distinct()
        .join(rtables.select("restaurant_id", "table_id"), "restaurant_id")
        .join(masks, ["table_id", "service_date"], "left")
        .select(
            *DAY, "table_id", F.coalesce("occupied_mask", F.lit(0).cast("bigint")).alias("mask"),
            F.lit(None).cast("bigint").alias("request_id"), F.lit(None).cast(live.schema["ts"].dataType).alias("ts"),
        ),
        "day-tables",
    )

    order = F.struct("ts", "request_id")

    def scan(eligible: DataFrame, tables: DataFrame) -> DataFrame:
        asked = _leading_per_shape(eligible, salts, widest).select(
            *DAY, F.lit(None).cast("bigint").alias("table_id"),
            slot_mask(start, duration).alias("mask"), "request_id", "ts",
        )
        # NULLs sort first: a day's tables (no ts) precede its requests.
        rows = tables.unionByName(asked).repartition(*DAY).sortWithinPartitions(
            *DAY, "ts", "request_id", "table_id"
        )
        chosen = rows.select(*DAY, "table_id", "mask", "request_id").mapInArrow(
            _first_fit, "request_id bigint, table_id bigint"
        )
        return eligible.select("request_id", "ts", *DAY, "member_id").join(chosen, "request_id")

    def passes(first: str) -> Column:
        return F.col(first).isNull() | (order <= F.col(first))

    def earliest(bookings: DataFrame) -> DataFrame:
        return bookings.groupBy(*gate).agg(F.min(order).alias("first_success"))

    scanned = _Versions(day_tables.select(*DAY).limit(0), "scanned")
    found = _Versions(scan(live, day_tables), "accepted")

    def accepted() -> DataFrame:
        last = scanned.rows().groupBy(*DAY).agg(F.max("_round").alias("_last"))
        return found.rows().join(last, DAY, "left").where("_round = coalesce(_last, 0)").drop("_round", "_last")

    firsts = _Versions(earliest(accepted()), "firsts")

    def latest() -> DataFrame:
        return firsts.rows().groupBy(*gate).agg(F.max_by("first_success", "_round").alias("first_success"))

    # A member with one request cannot be gated by the batch; the rest decide about more rounds.
    several = stored(live.groupBy(*gate).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*gate), "several")
    moved = firsts.rows().drop("_round").withColumn("_before", F.lit(None).cast(firsts.schema["first_success"].dataType))
    while True:
        touched = live.join(moved.join(several, gate, "left_semi"), gate)
        stale = stored(touched.where(passes("_before") != passes("first_success")).select(*DAY).distinct(), "stale")
        if stale.isEmpty():
            break
        again = live.join(stale, DAY, "left_semi").join(latest(), gate, "left").where(passes("first_success"))
        fresh = scan(again.drop("first_success"), day_tables.join(stale, DAY, "left_semi"))
        known = firsts.rows()
        found.append(fresh)
        scanned.append(stale)
        # Whoever held or holds a booking of a scanned day may have another first success.
        asked = found.rows().join(stale, DAY, "left_semi").select(*gate).distinct()
        before = known.groupBy(*gate).agg(F.max_by("first_success", "_round").alias("_before"))
        now = asked.join(earliest(accepted().join(asked, gate, "left_semi")), gate, "left")
        changed = now.join(before, gate, "left").where(~F.col("first_success").eqNullSafe(F.col("_before")))
        moved = stored(changed, "moved")
        firsts.append(moved.drop("_before"))

    won, latest_first = accepted().select("request_id", "table_id"), latest()
    own_earlier = F.coalesce(F.col("first_success") < order, F.lit(False))
    return (
        batch.join(latest_first, gate, "left")
        .join(won, "request_id", "left")
        .withColumn(
            "outcome",
            F.when(F.col("held_booking").isNotNull() | own_earlier, "has_open_booking")
            .when(F.col("table_id").isNotNull(), "confirmed")
            .otherwise("no_table"),
        )
        .withColumn(
            "existing_booking_id",
            F.when(
                F.col("outcome") == "has_open_booking",
                F.coalesce("held_booking", F.col("first_success.request_id")),
            ),
        )
        .select(
            "request_id", "ts", "member_id", *SHAPE, "table_id", "outcome", "existing_booking_id"
        )
    )
