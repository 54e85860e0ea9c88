"""Order-dependent operators against plain sequential replays, with keys that span partitions."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seatledger.operators.allocate import allocate_bookings
from seatledger.operators.availability import occupancy_masks
from seatledger.operators.lifecycle import final_states, lifecycle_replay
from seatledger.operators.ordering import dense_keys, row_number_within
from seatledger.operators.staffing import _pour, assign_staff_ordered, shared_desks

T0 = datetime(2030, 1, 1)


def ts(n: int) -> datetime:
    return T0 + timedelta(seconds=n)


# --- keys and row numbers ---------------------------------------------------------------------


def test_dense_keys_over_many_partitions_and_copies(spark):
    rng = random.Random(1)
    values = [rng.choice([7, 7, 7, rng.randrange(500)]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    keyed = dense_keys(df, ["v"], "k", start=10, partitions=7).collect()
    assert sorted(r.k for r in keyed) == list(range(10, 3010))
    assert [r.v for r in sorted(keyed, key=lambda r: r.k)] == sorted(values)


def test_dense_keys_of_nothing(spark):
    assert dense_keys(spark.createDataFrame([], "v int"), ["v"], "k").count() == 0


def test_row_number_within_a_hot_key(spark):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, rng.randrange(2, 60)]), i) for i in range(2000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v int")
    got = {(r.k, r.v): r.n for r in row_number_within(df, ["k"], ["v"], "n", partitions=6).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        for n, v in enumerate(sorted(v for kk, v in rows if kk == k), start=1):
            want[k, v] = n
    assert got == want


def test_row_numbers_of_null_keys_and_text(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, None, "a", "b"]), rng.choice([None, 1]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, j int, v int").repartition(3)
    got = {(r.k, r.j, r.v): r.n for r in row_number_within(df, ["k", "j"], ["v"], "n", partitions=5).collect()}
    want = {}
    for key in {r[:2] for r in rows}:
        for n, v in enumerate(sorted(v for *k, v in rows if tuple(k) == key), start=1):
            want[*key, v] = n
    assert got == want


def test_a_query_on_dense_keys_reads_its_columns_only(spark):
    df = spark.range(1000).select("id", F.repeat(F.lit("x"), 50).alias("payload"))
    keyed = dense_keys(df, ["id"], "k", partitions=4)
    plan = keyed.select("k").groupBy().max("k")._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan and "LogicalRDD" not in plan and "ExistingRDD" not in plan
    numbered = row_number_within(df, ["id"], ["payload"], "n").select("n")._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in numbered


# --- lifecycle --------------------------------------------------------------------------------

COMMANDS = ["new_booking", "member_in", "order_food", "member_out", "cancel_booking"]


def sequential_lifecycle(rows, start=None):
    """rows: (command_id, ts, member, command) -> {command_id: (booking, before, after)}"""
    state = dict(start or {})
    out = {}
    for cid, when, member, command in sorted(rows, key=lambda r: (r[1], r[0])):
        before, booking = state.get(member, ("none", None))
        after = before
        if command == "new_booking" and before not in ("scheduled", "ongoing"):
            after, booking = "scheduled", cid
        elif command == "member_in" and before == "scheduled":
            after = "ongoing"
        elif command == "member_out" and before == "ongoing":
            after = "completed"
        elif command == "cancel_booking" and before == "scheduled":
            after = "cancelled"
        state[member] = (after, booking)
        out[cid] = (booking, before, after)
    return out, state


def command_frame(spark, rows):
    return spark.createDataFrame(rows, "command_id long, ts timestamp, member_id long, command string")


def random_commands(seed, n, first_id=0):
    rng = random.Random(seed)
    return [
        (first_id + i, ts(rng.randrange(n)), rng.choice([1, 1, 1, rng.randrange(2, 30)]), rng.choice(COMMANDS))
        for i in range(n)
    ]


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_replay_of_a_busy_member(spark, partitions):
    rows = random_commands(3, 1500)
    want, _ = sequential_lifecycle(rows)
    got = lifecycle_replay(command_frame(spark, rows), partitions=partitions).collect()
    assert {r.command_id: (r.booking_id, r.status_before, r.status_after) for r in got} == want


def test_commands_without_a_member_match_no_booking(spark):
    rows = [(i, ts(i), None, COMMANDS[i % 2]) for i in range(40)]
    got = lifecycle_replay(command_frame(spark, rows), partitions=4).collect()
    assert {(r.command, r.outcome) for r in got} == {
        ("new_booking", "confirmed"), ("member_in", "no_scheduled_booking"),
    }
    assert len(got) == 40


def test_replay_in_two_batches_carries_state(spark):
    # Ids beyond 2**53 must survive the hand-over exactly.
    big = 2**60
    first, second = random_commands(4, 400, big + 1), random_commands(5, 400, big + 1001)
    second = [(c, when + timedelta(days=1), m, k) for c, when, m, k in second]
    _, after_first = sequential_lifecycle(first)
    want, _ = sequential_lifecycle(second, after_first)
    states = final_states(lifecycle_replay(command_frame(spark, first), partitions=4))
    got = lifecycle_replay(command_frame(spark, second), carried=states, partitions=4).collect()
    assert {r.command_id: (r.booking_id, r.status_before, r.status_after) for r in got} == want


# --- staffing -----------------------------------------------------------------------------------


def test_pour_equals_one_by_one():
    import numpy as np

    rng = random.Random(6)
    for _ in range(200):
        loads = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 6))])
        amount = rng.randrange(15)
        want = loads.copy()
        for _ in range(amount):
            want[int(np.argmin(want))] += 1
        assert _pour(loads.copy(), amount).tolist() == want.tolist()


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_staff_in_order_at_a_busy_restaurant(spark, partitions):
    rng = random.Random(7)
    shifts = [(r, 10 * r + k, rng.choice([1, 1, 4, 9])) for r in (1, 2, 3) for k in range(4)]
    ongoing = [(1000 + i, "ongoing", rng.choice(shifts)[1]) for i in range(12)]
    # Restaurant 4 has no staff; starts run in phases, so the loads become lopsided.
    arrivals = []
    for i in range(600):
        slot = rng.choice([1, 2, 3]) if i < 300 else rng.choice([2, 5, 10, 14])
        arrivals.append((i, ts(rng.randrange(500)), rng.choice([1, 1, 1, 2, 3, 4]), slot))
    load = {e: sum(x[2] == e for x in ongoing) for _, e, _ in shifts}
    want = {}
    for booking, when, restaurant, slot in sorted(arrivals, key=lambda a: (a[1], a[0])):
        can = [e for r, e, first in shifts if r == restaurant and first <= slot]
        chosen = min(can, key=lambda e: (load[e], e), default=None)
        want[booking] = chosen
        if chosen is not None:
            load[chosen] += 1
    got = assign_staff_ordered(
        spark.createDataFrame(arrivals, "booking_id long, ts timestamp, restaurant_id long, start_time_slot int"),
        spark.createDataFrame(shifts, "restaurant_id long, employee_id long, start_time_slot int"),
        spark.createDataFrame(ongoing, "booking_id long, booking_status string, employee_id long"),
        partitions=partitions,
    ).collect()
    assert {r.booking_id: r.employee_id for r in got} == want


def serve_sequentially(arrivals, shifts, ongoing):
    load = {e: sum(x[2] == e for x in ongoing) for _, e, _ in shifts}
    out = {}
    for booking, when, restaurant, slot in sorted(arrivals, key=lambda a: (a[1], a[0])):
        can = {e for r, e, first in shifts if r == restaurant and first <= slot}
        out[booking] = min(can, key=lambda e: (load[e], e), default=None)
        if out[booking] is not None:
            load[out[booking]] += 1
    return out


@pytest.mark.parametrize("seed, partitions", [(1, 1), (2, 4), (3, 9)])
def test_employees_shared_by_restaurants_carry_one_load(spark, seed, partitions):
    """Random rosters whose employees tie some restaurants into one desk, in chains and stars."""
    rng = random.Random(seed)
    shifts = [(r, 10 * r + k, rng.choice([1, 1, 4, 9])) for r in range(1, 9) for k in range(2)]
    shifts += [(r, 500 + r // 2, rng.choice([1, 3])) for r in (1, 2, 3, 4)] + [(r, 600, 2) for r in (4, 6, 7)] + [(1, 10, 8)]
    ongoing = [(1000 + i, "ongoing", rng.choice(shifts)[1]) for i in range(20)]
    arrivals = [
        (i, ts(rng.randrange(300)), rng.choice([1, 1, 2, 3, 4, 6, 7, 8, 11]), rng.choice([1, 2, 5, 10])) for i in range(400)
    ]
    got = assign_staff_ordered(
        spark.createDataFrame(arrivals, "booking_id long, ts timestamp, restaurant_id long, start_time_slot int"),
        spark.createDataFrame(shifts, "restaurant_id long, employee_id long, start_time_slot int"),
        spark.createDataFrame(ongoing, "booking_id long, booking_status string, employee_id long"),
        partitions=partitions,
    ).collect()
    assert {r.booking_id: r.employee_id for r in got} == serve_sequentially(arrivals, shifts, ongoing)
    desks = {(r.restaurant_id, r.desk) for r in shared_desks(
        spark.createDataFrame(shifts, "restaurant_id long, employee_id long, start_time_slot int")
    ).collect()}
    assert desks == {(2, 2), (3, 2), (4, 4), (6, 4), (7, 4)}


# --- allocation -----------------------------------------------------------------------------------

TABLES = [(1, 11), (1, 12), (2, 21), (3, 31), (3, 32), (3, 33)]
OPEN = "booking_id long, member_id long, table_id long, service_date date, start_time_slot int, booking_duration int"
ASK = (
    "request_id long, ts timestamp, member_id long, restaurant_id long, service_date date, "
    "start_time_slot int, booking_duration int"
)


def sequential_allocation(requests, open_bookings, gate):
    taken, held = set(), {}
    for booking, member, table, day, start, duration in open_bookings:
        taken |= {(table, day, s) for s in range(start, start + duration)}
        key = (member, day)[:gate]
        held[key] = min(booking, held.get(key, booking))
    out = {}
    for rid, when, member, restaurant, day, start, duration in sorted(requests, key=lambda r: (r[1], r[0])):
        key = (member, day)[:gate]
        if key in held:
            out[rid] = ("has_open_booking", None, held[key])
            continue
        slots = range(start, start + duration)
        fits = duration >= 1 and start + duration - 1 <= 14
        free = [t for r, t in TABLES if r == restaurant and all((t, day, s) not in taken for s in slots)]
        if not fits or not free:
            out[rid] = ("no_table", None, None)
            continue
        table = min(free)
        taken |= {(table, day, s) for s in slots}
        held[key] = rid
        out[rid] = ("confirmed", table, None)
    return out


@pytest.mark.parametrize("seed, gate", [(11, 2), (12, 1), (13, 2)])
def test_allocation_equals_sequential_replay(spark, seed, gate):
    rng = random.Random(seed)
    days = [date(2030, 1, 1), date(2030, 1, 2)]
    opened = [
        (9000 + i, rng.randrange(1, 12), rng.choice(TABLES)[1], rng.choice(days), rng.randrange(1, 14), 2)
        for i in range(4)
    ]
    # Restaurant 1 and one shape get most requests; restaurant 9 has no tables.
    asked = [
        (
            i, ts(rng.randrange(200)), rng.randrange(1, 40), rng.choice([1, 1, 1, 2, 3, 9]), rng.choice(days),
            *rng.choice([(3, 2), (3, 2), (rng.randrange(1, 15), rng.randrange(0, 6))]),
        )
        for i in range(250)
    ]
    open_df = spark.createDataFrame(opened, OPEN)
    got = allocate_bookings(
        spark.createDataFrame(asked, ASK),
        spark.createDataFrame(TABLES, "restaurant_id long, table_id long"),
        occupancy_masks(open_df), open_df,
        gate=("member_id", "service_date")[:gate],
    ).collect()
    assert {r.request_id: (r.outcome, r.table_id, r.existing_booking_id) for r in got} == sequential_allocation(
        asked, opened, gate
    )


def test_refusal_frees_a_table_elsewhere(spark):
    """Member 1 wins at restaurant 2 first, so their later success at restaurant 1 is undone in
    a second round, which hands the table to member 2, whose own later request then falls."""
    day = date(2030, 1, 1)
    asked = [
        (1, ts(1), 1, 2, day, 5, 1),
        (2, ts(2), 1, 1, day, 5, 1),
        (3, ts(3), 3, 1, day, 5, 1),
        (4, ts(4), 2, 1, day, 5, 1),
        (5, ts(5), 2, 2, day, 9, 1),
    ]
    got = allocate_bookings(
        spark.createDataFrame(asked, ASK),
        spark.createDataFrame(TABLES, "restaurant_id long, table_id long"),
        occupancy_masks(spark.createDataFrame([], OPEN)), spark.createDataFrame([], OPEN),
    ).collect()
    assert {r.request_id: (r.outcome, r.table_id, r.existing_booking_id) for r in got} == sequential_allocation(
        asked, [], 2
    )


def test_one_shape_holds_most_requests(spark):
    """Five thousand requests for one shape reach the sequential scan as a handful of rows."""
    from seatledger.operators.allocate import _leading_per_shape

    day = date(2030, 1, 1)
    df = spark.range(5000).select(
        F.col("id").alias("request_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("member_id"),
        F.lit(1).cast("long").alias("restaurant_id"), F.lit(day).alias("service_date"),
        F.lit(3).alias("start_time_slot"), F.lit(2).alias("booking_duration"), F.lit(2).alias("table_count"),
    )
    kept = [r.request_id for r in _leading_per_shape(df, 8, 5).collect()]
    assert sorted(kept) == [0, 1]
