"""Streaming jobs over several micro-batches against their batch twins."""

from __future__ import annotations

import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import at
from seatledger.operators import billing
from seatledger.session import scratch_path
from seatledger.streaming import jobs
from seatledger.streaming import lifecycle as keyed
from test_ordered import COMMANDS, random_commands, sequential_lifecycle, ts

COMMAND = "command_id long, ts timestamp, member_id long, command string"


def drop_files(spark, folder, parts, schema):
    """One parquet file per part, so that one file per trigger gives one micro-batch per part."""
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))
    return jobs.file_stream(spark, str(folder), files_per_trigger=1)


QUIET = [(None, at(10**6), None, None)]


def lifecycle_of(spark, folder, parts, delay="1 hour"):
    stream = drop_files(spark, folder, [*parts, QUIET], COMMAND)
    out = jobs.run_to_table(keyed.stream_lifecycle(stream, delay), scratch_path(spark, "t1"))
    rows = [(r.command_id, (r.booking_id, r.status_before, r.status_after)) for r in out.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_lifecycle_equals_replay_however_commands_arrive(spark, tmp_path):
    """Disorder and repeats within the delay change nothing, across micro-batches either."""
    rows = random_commands(20, 240) + [(900 + i, ts(i), None, COMMANDS[i % 2]) for i in range(6)]
    rng = random.Random(1)
    mixed = rng.sample(rows, len(rows))
    parts = [mixed[k::4] + rng.sample(rows, 40) for k in range(4)]
    # The whole log spans four minutes; with an hour of delay nothing is late.
    want, _ = sequential_lifecycle([r for r in rows if r[2] is not None])
    alone = {c: (c if k == "new_booking" else None, "none", "scheduled" if k == "new_booking" else "none") for c, _, m, k in rows if m is None}
    assert lifecycle_of(spark, tmp_path / "in", parts) == {**want, **alone}


def test_lifecycle_keeps_state_and_drops_late_commands(spark, tmp_path):
    """Steps an hour apart with a short delay: states carry over, what comes too late is left out."""
    parts = [[(c, when + timedelta(hours=i), m, k) for c, when, m, k in random_commands(30 + i, 60, 1000 * i)] for i in range(4)]
    late = [(7000 + k, ts(k), 1, "new_booking") for k in range(5)]
    sent = [parts[0], parts[1], parts[2] + late + parts[0][:20], parts[3] + parts[2]]
    want, _ = sequential_lifecycle(sum(parts, []))
    assert lifecycle_of(spark, tmp_path / "in", sent, "1 minute") == want


def test_lifecycle_ignores_what_is_no_command(spark, tmp_path):
    parts = [[(1, at(1), 1, "new_booking"), (2, at(2), 1, "sing"), (3, at(3), 1, None), (None, at(4), 1, "member_in"), (5, None, 1, "member_in")]]
    assert lifecycle_of(spark, tmp_path / "in", parts) == {1: (1, "none", "scheduled")}


def test_members_share_keys_of_the_state(spark, tmp_path, monkeypatch):
    """State grows with groups, not with members, and members of a group don't meet."""
    monkeypatch.setattr(keyed, "GROUPS", 3, raising=False)
    rows = [(4 * m + k, at(m + 100 * k), m, COMMANDS[k % 2]) for m in range(-20, 40) for k in range(3)]
    rows += [(1000 + m, at(50), None, COMMANDS[m % 2]) for m in range(20)]
    # The last part's watermark decides the commands of the first two minutes; the members' states stay.
    stream = drop_files(spark, tmp_path / "in", [rows, [(5000, at(130), 5, "sing")], QUIET], COMMAND)
    path = scratch_path(spark, "t1")
    query = (
        keyed.stream_lifecycle(stream, "1 minute").writeStream.format("parquet")
        .option("checkpointLocation", f"{path}.checkpoint").trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert kept and max(kept) <= 3 * 4
    got = {r.command_id: (r.booking_id, r.status_before, r.status_after) for r in spark.read.parquet(path).collect()}
    want, _ = sequential_lifecycle([r for r in rows if r[2] is not None])
    alone = {1000 + m: (None if m % 2 else 1000 + m, "none", "none" if m % 2 else "scheduled") for m in range(20)}
    assert {c: v for c, v in got.items()} == {**want, **alone}


def test_a_resting_stream_holds_the_last_commands_back(spark, tmp_path):
    stream = drop_files(spark, tmp_path / "in", [[(1, at(0), 1, "new_booking"), (2, at(120), 1, "member_in")]], COMMAND)
    out = jobs.run_to_table(keyed.stream_lifecycle(stream), scratch_path(spark, "t1"))
    assert [r.command_id for r in out.collect()] == [1]


LINE = "booking_id long, item_id long, quantity int"


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(1, Decimal("2.50")), (2, Decimal("4.00"))], "item_id long, price decimal(10,2)")


def test_billing_equals_batch(spark, tmp_path, items):
    parts = [[(1, 1, 2), (1, 2, 1)], [(2, 1, 1), (2, 9, 1)], [(1, 1, 2)]]
    stream = drop_files(spark, tmp_path / "in", parts, LINE)
    out = jobs.run_to_table(jobs.stream_billing(stream, items), scratch_path(spark, "t2"))
    whole = spark.createDataFrame(sum(parts, []), LINE)
    twin = billing.priced_lines(whole, items).select("booking_id", "item_id", "total_amount")
    assert sorted(map(tuple, out.drop("payment_status").collect())) == sorted(map(tuple, twin.collect()))


ORDERED = LINE + ", order_time timestamp"
DONE = "booking_id long, restaurant_id long, status_before string, booking_status string, completed_at timestamp"
DAY = 1_440


@pytest.fixture
def places(spark):
    return spark.createDataFrame([(7, Decimal("6.00"))], "restaurant_id long, tax decimal(3,2)")


def settle(spark, folder, line_parts, done_parts, items, places):
    """Totals and bills after everything has arrived; heartbeats close the last day."""
    beat_lines, beat_done = [(-1, -1, 0, at(90 * DAY))], [(-1, -1, "ongoing", "completed", at(90 * DAY))]
    lines = drop_files(spark, folder / "lines", [*line_parts, beat_lines], ORDERED)
    done = drop_files(spark, folder / "done", [*done_parts, beat_done], DONE)
    totals = jobs.run_to_table(jobs.stream_settlement(done, lines, items, places), scratch_path(spark, "t3")).where("booking_id > 0")
    paid = jobs.run_to_table(jobs.stream_paid_bills(done, lines, items), scratch_path(spark, "t3")).where("booking_id > 0")
    return totals, sorted((r.booking_id, r.item_id, r.total_amount, r.payment_status) for r in paid.collect())


def test_settlement_equals_batch(spark, tmp_path, items, places):
    lines = [[(1, 1, 2, at(60)), (2, 2, 1, at(50)), (1, 2, 1, at(30))], [(3, 2, 5, at(DAY + 5))], [(6, 1, 1, at(3 * DAY + 9)), (2, 1, 1, at(70))]]
    first = (1, 7, "ongoing", "completed", at(100))
    done = [
        [first, first, (4, 7, "ongoing", "completed", at(80))],
        [first, (2, 7, "ongoing", "completed", at(90)), (5, 7, "scheduled", "cancelled", at(95))],
        [(3, 7, "completed", "completed", at(DAY + 9)), (6, 7, "ongoing", "completed", at(3 * DAY + 20)), first],
    ]
    totals, paid = settle(spark, tmp_path, lines, done, items, places)
    whole = spark.createDataFrame([r[:3] for r in sum(lines, [])], LINE)
    state = spark.createDataFrame([(b, 7, "completed") for b in (1, 2, 4, 6)], "booking_id long, restaurant_id long, booking_status string")
    twin = billing.past_bookings(state, whole, items, places)
    want = sorted(map(str, twin.select(sorted(twin.columns)).collect()))
    assert sorted(map(str, totals.select(sorted(twin.columns)).collect())) == want
    # Booking 4 has no orders, booking 3 was completed before; the late second line of booking 2 counts.
    assert {r.booking_id: r.bills for r in totals.collect()} == {1: 2, 2: 2, 4: 0, 6: 1}
    assert paid == [
        (1, 1, Decimal("5.00"), "paid"), (1, 2, Decimal("4.00"), "paid"), (2, 1, Decimal("2.50"), "paid"),
        (2, 2, Decimal("4.00"), "paid"), (6, 1, Decimal("2.50"), "paid"),
    ]


def test_settlement_state_is_bounded_and_no_batch_reads_old_lines(spark, tmp_path, items, places):
    """Twelve days, a micro-batch each: state and input of a batch stay at a day or two."""
    per_day = 20
    lines = [[(100 * d + k, 1, 1, at(d * DAY + k)) for k in range(per_day)] for d in range(1, 13)]
    done = [[(100 * d + k, 7, "ongoing", "completed", at(d * DAY + 500 + k)) for k in range(per_day)] for d in range(1, 13)]
    stream = jobs.stream_settlement(drop_files(spark, tmp_path / "done", done, DONE), drop_files(spark, tmp_path / "lines", lines, ORDERED), items, places)
    path = scratch_path(spark, "t3")
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", f"{path}.checkpoint").trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(steps) == 12
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in steps]
    assert max(held) == max(held[:5]) and max(held) <= 12 * per_day
    # Each batch reads its own files of both streams and nothing else of them.
    assert {p["numInputRows"] for p in steps} == {2 * per_day}
    settled = spark.read.schema(stream.schema).parquet(path)
    assert settled.count() >= 10 * per_day and settled.where("bills <> 1").count() == 0


def test_delivery_covers_the_table_and_repeats_some_of_it(spark):
    rows = [(i, at(i * 60), i % 3, COMMANDS[i % 5]) for i in range(500)]
    df = spark.createDataFrame(rows, COMMAND)
    path = scratch_path(spark, "landed")
    landed = jobs.deliver(df, path, "ts", {"command_id": -1})
    assert landed.isStreaming
    got = [r.command_id for r in spark.read.parquet(path).collect()]
    assert set(got) == {-1, *range(500)} and 501 < len(got) < 700
    nothing = jobs.deliver(df.limit(0), scratch_path(spark, "landed"), "ts", {})
    assert jobs.run_to_table(nothing, scratch_path(spark, "none")).count() == 0


def test_late_requests_miss_closed_windows(spark, tmp_path):
    parts = [
        [(1, at(5), 1, "new_booking"), (2, at(20), 1, "new_booking"), (3, at(30), 1, "member_in")],
        [(4, at(200), 1, "new_booking")],
        # Lateness is judged by the watermark of the batch before, so one more batch has to pass.
        [(8, at(210), 2, "new_booking")],
        [(5, at(6), 1, "new_booking"), (6, at(205), 1, "new_booking"), (7, at(400), 2, "new_booking")],
    ]
    stream = drop_files(spark, tmp_path / "in", parts, COMMAND)
    out = jobs.run_to_table(jobs.demand_tumbling(stream), scratch_path(spark, "t4"))
    hours = {r.h: r.requests for r in out.select(F.hour("window_start").alias("h"), "requests").collect()}
    # Command 5 comes after its window closed; the window of command 7 is still open.
    assert sorted(hours.values()) == [2, 3] and hours[min(hours)] == 2


def test_redelivered_commands_are_dropped(spark, tmp_path):
    rows = [(i, at(i), 1, COMMANDS[i % 5]) for i in range(20)]
    stream = drop_files(spark, tmp_path / "in", [rows, rows[10:], rows[:15]], COMMAND)
    out = jobs.run_to_table(jobs.dedupe_commands(stream), scratch_path(spark, "t5"))
    assert sorted(r.command_id for r in out.collect()) == list(range(20))
    assert out.where(F.col("ts").isNull()).count() == 0
