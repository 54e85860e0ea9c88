"""Which employee serves a booking.

Only the shift's start is compared with the booking's start; role and shift end play no
part. Idle employees come first, ties go to the lowest employee id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seatledger.functions.expressions import SLOTS_PER_DAY
from seatledger.operators.graph import components
from seatledger.operators.ordering import SEGMENT, ordered_segments


def staff_load(shifts: DataFrame, booking_status: DataFrame) -> DataFrame:
    """Ongoing bookings per rostered employee, NULL for an idle one."""
    load = (
        booking_status.where(
            (F.col("booking_status") == "ongoing") & F.col("employee_id").isNotNull()
        )
        .groupBy("employee_id")
        .agg(F.count(F.lit(1)).cast("bigint").alias("load"))
    )
    return shifts.select("employee_id").distinct().join(load, "employee_id", "left")


def _starts_covered(shifts: DataFrame, slots: int) -> DataFrame:
    """(restaurant, slot, employee) for every booking start a shift is eligible for.

    Expanding shifts over slots turns ``shift start <= booking start`` into an equi-key,
    so no booking is ever paired with every shift of its restaurant.
    """
    earliest = shifts.groupBy("restaurant_id", "employee_id").agg(
        F.min("start_time_slot").alias("first_slot")
    )
    return earliest.where(F.col("first_slot") <= slots).select(
        "restaurant_id", "employee_id",
        F.explode(F.sequence(F.greatest("first_slot", F.lit(1)), F.lit(slots))).alias("start_time_slot"),
    )


def eligible_staff(bookings: DataFrame, shifts: DataFrame, slots: int = SLOTS_PER_DAY) -> DataFrame:
    """How many employees could serve each booking, and the lowest id among them."""
    per_start = (
        _starts_covered(shifts, slots)
        .groupBy("restaurant_id", "start_time_slot")
        .agg(F.count(F.lit(1)).alias("eligible"), F.min("employee_id").alias("first_employee_id"))
    )
    return bookings.select("booking_id", "restaurant_id", "start_time_slot").join(
        per_start, ["restaurant_id", "start_time_slot"], "left"
    ).select(
        "booking_id", "restaurant_id", "start_time_slot",
        F.coalesce("eligible", F.lit(0)).cast("bigint").alias("eligible"),
        "first_employee_id",
    )


def assign_staff_snapshot(
    bookings: DataFrame, shifts: DataFrame, booking_status: DataFrame, slots: int = SLOTS_PER_DAY
) -> DataFrame:
    """Least-loaded eligible employee per booking against one snapshot of the loads.

    The choice is the same for all bookings of a (restaurant, start), so it is made once
    per pair and then looked up.
    """
    load = staff_load(shifts, booking_status)
    choice = (
        _starts_covered(shifts, slots)
        .join(load, "employee_id")
        .groupBy("restaurant_id", "start_time_slot")
        .agg(F.min(F.struct(F.coalesce("load", F.lit(0)).alias("load"), "employee_id")).alias("_best"))
        .select("restaurant_id", "start_time_slot", F.col("_best.employee_id").alias("employee_id"))
    )
    return bookings.select("booking_id", "restaurant_id", "start_time_slot").join(
        choice, ["restaurant_id", "start_time_slot"], "left"
    ).select("booking_id", "restaurant_id", "start_time_slot", "employee_id")


# --- ordered assignment ------------------------------------------------------------------

# A desk is a restaurant, or all restaurants that shared employees tie together.
_ENTRY = pa.struct([
    ("restaurant_id", pa.int64()), ("employee_id", pa.int64()), ("first_slot", pa.int32()), ("load", pa.int64()),
])
_LOADS = "array<struct<restaurant_id: bigint, employee_id: bigint, first_slot: int, load: bigint>>"
_OUT = f"desk bigint, segment_id int, booking_id bigint, employee_id bigint, loads {_LOADS}"
_OUT_ARROW = pa.schema([
    ("desk", pa.int64()), ("segment_id", pa.int32()), ("booking_id", pa.int64()), ("employee_id", pa.int64()),
    ("loads", pa.list_(_ENTRY)),
])


class _Desk:
    """Loads of a desk's employees, with a heap of (load, employee) for each restaurant and first slot.

    An employee who works at several restaurants stands in several heaps; loads only grow,
    so an entry that another restaurant has overtaken is renewed when it comes to the top.
    """

    def __init__(self, loads: list[dict] | None):
        self._roster = loads or []
        self._load = {e["employee_id"]: e["load"] for e in self._roster}
        self._heaps: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for e in self._roster:
            own = self._heaps.setdefault(e["restaurant_id"], {})
            own.setdefault(e["first_slot"], []).append((e["load"], e["employee_id"]))
        for own in self._heaps.values():
            for heap in own.values():
                heapq.heapify(heap)

    def serve(self, restaurant: int, slot: int | None) -> int | None:
        heaps = [h for first, h in self._heaps.get(restaurant, {}).items() if slot is not None and first <= slot]
        for heap in heaps:
            while heap[0][0] != self._load[heap[0][1]]:
                heapq.heapreplace(heap, (self._load[heap[0][1]], heap[0][1]))
        if not heaps:
            return None
        heap = min(heaps, key=lambda h: h[0])
        load, employee = heap[0]
        self._load[employee] = load + 1
        heapq.heapreplace(heap, (load + 1, employee))
        return employee

    def loads(self) -> list[dict]:
        return [{**e, "load": self._load[e["employee_id"]]} for e in self._roster]


def _serve_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of (desk, segment): the loads row first, then check-ins in order.

    Emits one row per check-in and, when a piece ends, one row with its final loads.
    """
    piece, desk = None, _Desk(None)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows), _OUT_ARROW)], schema=_OUT_ARROW
        )

    for batch in batches:
        out = []
        for number, segment, incoming, restaurant, slot, booking in zip(
            *(batch.column(i).to_pylist() for i in range(6))
        ):
            if piece != (number, segment):
                if piece is not None:
                    out.append((*piece, None, None, desk.loads()))
                piece, desk = (number, segment), _Desk(None)
            if booking is None:
                desk = _Desk(incoming)
            else:
                out.append((number, segment, booking, desk.serve(restaurant, slot), None))
        if out:
            yield table(out)
    if piece is not None:
        yield table([(*piece, None, None, desk.loads())])


def _pour(loads: np.ndarray, amount: int) -> np.ndarray:
    """Loads after giving ``amount`` units one by one to the least loaded (lowest index wins)."""
    if amount <= 0 or len(loads) == 0:
        return loads
    ranked = np.sort(loads)
    needed = ranked * np.arange(1, len(ranked) + 1) - np.cumsum(ranked)
    width = int(np.searchsorted(needed, amount, side="right"))
    level, extra = divmod(int(ranked[:width].sum()) + amount, width)
    filled = np.maximum(loads, level)
    at_level = np.flatnonzero(loads <= level)[:extra]
    filled[at_level] += 1
    return filled


def _predict_loads(pdf: pd.DataFrame) -> pd.DataFrame:
    """Expected loads at the start of each piece of one desk, from counts per restaurant and start slot."""
    pdf = pdf.sort_values([SEGMENT, "restaurant_id"])
    roster = [dict(e) for e in pdf["roster"].iloc[0]]
    staff = sorted({e["employee_id"]: e["load"] for e in roster}.items())
    place = {employee: k for k, (employee, _) in enumerate(staff)}
    loads = np.array([load for _, load in staff], dtype=np.int64)
    starts: dict[int, list[tuple[int, int]]] = {}
    for e in roster:
        starts.setdefault(e["restaurant_id"], []).append((place[e["employee_id"]], e["first_slot"]))
    desks, segments, incoming = [], [], []
    for (desk, segment), rows in pdf.groupby(["desk", SEGMENT], sort=True):
        desks.append(desk)
        segments.append(segment)
        incoming.append([{**e, "load": int(loads[place[e["employee_id"]]])} for e in roster])
        for restaurant, demand in zip(rows["restaurant_id"], rows["demand"]):
            own = starts.get(restaurant, [])
            for slot, amount in enumerate(demand, start=1):
                can = np.array(sorted(k for k, first in own if first <= slot), dtype=np.int64)
                loads[can] = _pour(loads[can], int(amount))
    return pd.DataFrame({"desk": desks, SEGMENT: segments, "loads": incoming})


def shared_desks(shifts: DataFrame) -> DataFrame:
    """(restaurant_id, desk) of the restaurants that employees with shifts at several tie together.

    Restaurants are nodes and an employee is a star around their least restaurant, so an
    employee with very many restaurants makes no pairs; a desk has the number of its least
    restaurant.
    """
    works = shifts.select("employee_id", "restaurant_id").where(F.col("restaurant_id").isNotNull()).distinct()
    least = works.groupBy("employee_id").agg(F.min("restaurant_id").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = works.join(least, "employee_id").where("restaurant_id <> a").select("a", F.col("restaurant_id").alias("b"))
    return components(ties).select(F.col("node").alias("restaurant_id"), F.col("root").alias("desk"))


def assign_staff_ordered(
    checkins: DataFrame,
    shifts: DataFrame,
    booking_status: DataFrame,
    slots: int = SLOTS_PER_DAY,
    partitions: int | None = None,
) -> DataFrame:
    """Check-ins served in (ts, booking_id) order, each one raising its server's load.

    An employee with shifts at several restaurants carries one load, so those restaurants
    form one desk; desks are the connected components of the restaurant-employee graph.
    Check-ins are range-partitioned by (desk, order), so a busy desk is cut into pieces.
    A piece can only be replayed once the loads at its start are known: they are predicted
    from the counts per restaurant and start slot, the pieces are replayed in parallel, and
    a piece whose predecessor ended with other loads than predicted is replayed again. The
    first k pieces of a desk are final after k rounds, so the loop ends with the sequential
    answer; without shared employees the prediction is usually exact. A task holds one entry
    per employee and restaurant of the desk it works on, never its check-ins.

    Runs its rounds while it is called; what it returns is the last pass.
    """
    several_places = shifts.groupBy("employee_id").agg(
        F.min("restaurant_id").alias("least"), F.max("restaurant_id").alias("most")
    ).where("least <> most")
    tied = None if several_places.isEmpty() else shared_desks(shifts).checkpoint()

    def at_desk(df: DataFrame) -> DataFrame:
        if tied is None:
            return df.withColumn("desk", F.col("restaurant_id"))
        return df.join(tied, "restaurant_id", "left").withColumn("desk", F.coalesce("desk", "restaurant_id"))

    member = (
        shifts.groupBy("restaurant_id", "employee_id").agg(F.min("start_time_slot").alias("first_slot"))
        .join(staff_load(shifts, booking_status), "employee_id")
    )
    roster = at_desk(member).groupBy("desk").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("restaurant_id").cast("bigint").alias("restaurant_id"),
            F.col("employee_id").cast("bigint").alias("employee_id"),
            F.col("first_slot").cast("int").alias("first_slot"),
            F.coalesce("load", F.lit(0)).cast("bigint").alias("load"),
        ))).alias("roster")
    )
    ranged = ordered_segments(
        at_desk(checkins.select("restaurant_id", "ts", "booking_id", "start_time_slot")), ["desk", "ts", "booking_id"], partitions
    )
    slot = F.col("start_time_slot")
    demand = ranged.groupBy("desk", SEGMENT, "restaurant_id").agg(
        F.array(*[F.count_if(slot == s) for s in range(1, slots + 1)]).alias("demand")
    ).checkpoint()
    key = ["desk", SEGMENT]
    pieces = demand.select(*key).distinct()

    def replay(rows: DataFrame, incoming: DataFrame) -> DataFrame:
        nothing = F.lit(None)
        seeds = incoming.select(
            *key, F.col("loads").cast(_LOADS).alias("loads"), nothing.cast("bigint").alias("restaurant_id"),
            nothing.cast("int").alias("start_time_slot"), nothing.cast("bigint").alias("booking_id"),
            nothing.cast("timestamp").alias("ts"),
        )
        steps = rows.select(
            *key, nothing.cast(_LOADS).alias("loads"), F.col("restaurant_id").cast("bigint").alias("restaurant_id"),
            F.col("start_time_slot").cast("int").alias("start_time_slot"), "booking_id", F.col("ts").cast("timestamp").alias("ts"),
        )
        # NULLs sort first: the seed of a piece precedes its check-ins.
        return (
            seeds.unionByName(steps).repartition(*key).sortWithinPartitions(*key, "ts", "booking_id")
            .select(*key, "loads", "restaurant_id", "start_time_slot", "booking_id")
            .mapInArrow(_serve_in_order, _OUT)
        )

    several = pieces.groupBy("desk").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    cut = demand.join(several, "desk", "left_semi").join(roster, "desk").checkpoint()
    opening = roster.select("desk", F.col("roster").alias("loads"))
    whole = pieces.join(several, "desk", "left_anti").join(opening, "desk", "left")
    settled = whole.select(*key, "loads")

    if not cut.isEmpty():
        # At most two border pieces per range partition, so these frames stay small.
        incoming = cut.groupBy("desk").applyInPandas(
            _predict_loads, f"desk bigint, {SEGMENT} int, loads {_LOADS}"
        ).checkpoint()
        redo, ended = incoming, None
        while True:
            rows = ranged.join(F.broadcast(redo.select(*key)), key, "left_semi")
            fresh = replay(rows, redo).where("loads is not null").select(*key, F.col("loads").alias("after"))
            if ended is not None:
                fresh = fresh.unionByName(ended.join(redo.select(*key), key, "left_anti"))
            ended = fresh.checkpoint()
            order = Window.partitionBy("desk").orderBy(SEGMENT)
            handed = ended.select(*key, F.lag("after").over(order).alias("handed"))
            compared = incoming.join(handed, key).select(
                *key, "loads", F.coalesce("handed", "loads").alias("handed")
            ).checkpoint()
            redo = compared.where("handed != loads").select(*key, F.col("handed").alias("loads"))
            incoming = compared.select(*key, F.col("handed").alias("loads"))
            if redo.isEmpty():
                break
        settled = settled.unionByName(incoming)

    served = replay(ranged, settled).where("booking_id is not null").select("booking_id", "employee_id")
    return checkins.select("booking_id", "restaurant_id", "start_time_slot", "ts").join(served, "booking_id")
