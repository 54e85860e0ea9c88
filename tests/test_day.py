"""A hand-worked day: book, check in, order, check out, cancel."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import at, booking_request, frame, small_database
from seatledger.plans import day


def _commands(spark, rows):
    return frame(spark, "command", rows)


def _by_id(df, value, key="command_id"):
    return {r[key]: r[value] for r in df.collect()}


@pytest.fixture(scope="module")
def story(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("day")
    steps = iter(range(100))

    def keep(db):
        return day.settle_to(db, str(folder / f"step{next(steps)}"))

    db = small_database(spark)
    out = {}
    db, out["book"] = day.book(db, _commands(spark, [
        booking_request(1, 1, 1, 3, 2),    # table 11
        booking_request(2, 2, 1, 4, 2),    # overlaps: table 12
        booking_request(3, 3, 1, 4, 1),    # both taken in slot 4
        booking_request(4, 1, 2, 1, 1),    # member 1 already has booking 1
        booking_request(5, 3, 2, 13, 3),   # runs past the last slot
        booking_request(6, 3, 2, 13, 0),   # empty interval
        booking_request(7, 3, 2, 13, 2),   # member 3 succeeds at last: table 21
        booking_request(8, 4, 1, 6, 1),    # free again after slot 5: table 11
    ]))
    db = keep(db)
    db, out["in"] = day.check_in(db, _commands(spark, [
        {"command_id": 20, "ts": at(20), "command": "member_in", "member_id": 1},
        {"command_id": 21, "ts": at(21), "command": "member_in", "member_id": 2},
        {"command_id": 22, "ts": at(22), "command": "member_in", "member_id": 4},
        {"command_id": 23, "ts": at(23), "command": "member_in", "member_id": 4},
    ]))
    db = keep(db)
    db, out["order"] = day.order_food(db, _commands(spark, [
        {"command_id": 30, "ts": at(30), "command": "order_food", "booking_id": 1, "item_id": 1, "quantity": 3},
        {"command_id": 31, "ts": at(31), "command": "order_food", "booking_id": 1, "item_id": 2, "quantity": 1},
        {"command_id": 32, "ts": at(32), "command": "order_food", "booking_id": 1, "item_id": 3, "quantity": 1},
        {"command_id": 33, "ts": at(33), "command": "order_food", "booking_id": 7, "item_id": 3, "quantity": 1},
        {"command_id": 34, "ts": at(34), "command": "order_food", "booking_id": 99, "item_id": 3, "quantity": 1},
    ]))
    db = keep(db)
    db, out["out"] = day.check_out(db, _commands(spark, [
        {"command_id": 40, "ts": at(40), "command": "member_out", "member_id": 1},
        {"command_id": 41, "ts": at(41), "command": "member_out", "member_id": 2},
        {"command_id": 42, "ts": at(42), "command": "member_out", "member_id": 2},
    ]))
    db = keep(db)
    db, out["cancel"] = day.cancel(db, _commands(spark, [
        {"command_id": 50, "ts": at(50), "command": "cancel_booking", "booking_id": 7},
        {"command_id": 51, "ts": at(51), "command": "cancel_booking", "booking_id": 7},
        {"command_id": 52, "ts": at(52), "command": "cancel_booking", "booking_id": 1},
        {"command_id": 53, "ts": at(53), "command": "cancel_booking", "booking_id": 99},
    ]))
    db = keep(db)
    db, out["second"] = day.book(db, _commands(spark, [
        booking_request(60, 1, 1, 3, 3, 60),   # completed before; slots 3-5 of table 11 are free again
        booking_request(61, 3, 2, 13, 2, 61),  # cancelled before; table 21 is free again
        booking_request(62, 4, 2, 1, 1, 62),   # still ongoing
        booking_request(63, 2, 1, 6, 1, 63),   # table 11 is taken in slot 6 by booking 8: table 12
    ]))
    return keep(db), out


def test_second_wave(story):
    _, out = story
    assert _by_id(out["second"], "outcome") == {
        60: "confirmed", 61: "confirmed", 62: "has_open_booking", 63: "confirmed",
    }
    assert _by_id(out["second"], "table_id") == {60: 11, 61: 21, 62: None, 63: 12}
    assert _by_id(out["second"], "booking_id")[62] == 8


def test_booking_outcomes(story):
    _, out = story
    assert _by_id(out["book"], "outcome") == {
        1: "confirmed", 2: "confirmed", 3: "no_table", 4: "has_open_booking",
        5: "no_table", 6: "no_table", 7: "confirmed", 8: "confirmed",
    }
    tables = {k: v for k, v in _by_id(out["book"], "table_id").items() if v is not None}
    assert tables == {1: 11, 2: 12, 7: 21, 8: 11}


def test_check_in_assigns_least_loaded(story):
    db, out = story
    assert _by_id(out["in"], "outcome") == {
        20: "checked_in", 21: "checked_in", 22: "checked_in", 23: "no_scheduled_booking",
    }
    # 1 then 2 are idle in turn; employee 3 starts at slot 6 and is idle for booking 8.
    served = _by_id(db.booking_status, "employee_id", "booking_id")
    assert {b: served[b] for b in (1, 2, 7, 8)} == {1: 1, 2: 2, 7: None, 8: 3}


def test_orders_and_bills(story):
    db, out = story
    assert _by_id(out["order"], "outcome") == {
        30: "accepted", 31: "item_unavailable", 32: "item_unavailable",
        33: "invalid_booking", 34: "invalid_booking",
    }
    assert [(r.order_id, r.total_amount, r.payment_status) for r in db.billing.collect()] == [
        (30, Decimal("13.80"), "paid")
    ]


def test_checkout_totals(story):
    db, out = story
    assert _by_id(out["out"], "outcome") == {40: "checked_out", 41: "checked_out", 42: "not_checked_in"}
    past = {r.booking_id: (r.total_price, r.total_tax, r.total_price_after_tax) for r in db.past_booking.collect()}
    # 13.80 * 8.25% = 1.1385 -> 1.14; booking 2 ordered nothing.
    assert past == {1: (Decimal("13.80"), Decimal("1.14"), Decimal("14.94")), 2: (None, None, None)}


def test_cancellation(story):
    db, out = story
    assert _by_id(out["cancel"], "outcome") == {
        50: "cancelled", 51: "not_allowed", 52: "not_allowed", 53: "not_found",
    }
    assert _by_id(db.member, "cancellation_penalty", "member_id")[3] == Decimal("2.00")
    assert _by_id(db.booking_status, "booking_status", "booking_id") == {
        1: "completed", 2: "completed", 7: "cancelled", 8: "ongoing",
        60: "scheduled", 61: "scheduled", 63: "scheduled",
    }


def test_grid_keeps_stale_id_only_after_checkout(story):
    db, _ = story
    cells = {(r.table_id, r.slot_id): (r.booking_id, r.status) for r in db.table_status.collect()}
    assert len(cells) == 4 * 14
    assert cells[(12, 4)] == (2, "vacant")   # checked out
    assert cells[(21, 12)] == (None, "vacant")
    assert cells[(11, 3)] == (60, "occupied")  # taken over from booking 1
    assert cells[(11, 6)] == (8, "occupied")
    assert sum(status == "occupied" for _, status in cells.values()) == 1 + 3 + 2 + 1


def test_log(story):
    db, _ = story
    log = _by_id(db.program_log, "message", "log_id")
    # Everything is logged but the accepted order.
    assert len(log) == 8 + 4 + 4 + 3 + 4 + 4
    assert log[1] == "Booking with ID 1 created for member ID1. SUCCESS!!"
    assert log[4] == "Member ID: 1 with existing booking with id 1 tried new booking. FAILED!!"
    assert log[50] == "Booking ID 7 by member ID 3 is CANCELLED!!"
    assert log[53] == "Booking ID 99 does not eexist and cannot be cancelled. FAILED!!"
    assert log[32] == "MenuItem ID 3 at restaurant ID 1 was not available for booking ID 1. FAILED!!"


def test_every_outcome_with_its_message(spark):
    """Hand-worked decisions, with either gate; NULL keys match nothing."""
    from datetime import date

    from seatledger.operators import lifecycle

    state = spark.createDataFrame(
        [
            (1, 1, 7, date(2030, 5, 4), "scheduled"), (2, 1, 7, date(2030, 5, 5), "scheduled"), (3, 2, 7, date(2030, 5, 4), "ongoing"),
            (4, 3, 7, date(2030, 5, 4), "completed"), (5, None, 7, date(2030, 5, 4), None),
        ],
        "booking_id long, member_id long, restaurant_id long, service_date date, booking_status string",
    )
    rtables = spark.createDataFrame([(71, 7), (72, 7)], "table_id long, restaurant_id long")
    masks = spark.createDataFrame([(71, date(2030, 5, 4), 0b0110)], "table_id long, service_date date, occupied_mask long")
    menu = spark.createDataFrame([(7, 1, True), (7, 2, False), (7, 2, False)], "restaurant_id long, item_id long, availability boolean")
    rows = [
        # command, member, booking, restaurant, date, start, duration, item -> outcome by either gate
        (10, "new_booking", 1, None, 7, date(2030, 5, 4), 2, 1, None), (11, "new_booking", 1, None, 7, date(2030, 5, 9), 2, 1, None),
        (12, "new_booking", 9, None, 7, date(2030, 5, 4), 13, 3, None), (13, "new_booking", None, None, 7, date(2030, 5, 4), 2, 1, None),
        (14, "new_booking", 9, None, 8, date(2030, 5, 4), 2, 1, None), (15, "member_in", 1, None, None, None, None, None, None),
        (16, "member_in", 2, None, None, None, None, None, None), (17, "member_out", 2, None, None, None, None, None, None),
        (18, "member_out", 1, None, None, None, None, None, None), (19, "order_food", None, 3, None, None, None, None, 1),
        (20, "order_food", None, 3, None, None, None, None, 2), (21, "order_food", None, 1, None, None, None, None, 1),
        (22, "cancel_booking", None, 1, None, None, None, None, None), (23, "cancel_booking", None, 4, None, None, None, None, None),
        (24, "cancel_booking", None, 99, None, None, None, None, None), (25, "cancel_booking", None, None, None, None, None, None, None),
        (26, "cancel_booking", None, 5, None, None, None, None, None), (27, "dance", 1, 1, 7, date(2030, 5, 4), 1, 1, 1),
    ]
    commands = spark.createDataFrame(
        rows, "command_id long, command string, member_id long, booking_id long, restaurant_id long, service_date date, "
              "start_time_slot int, booking_duration int, item_id long",
    ).withColumn("ts", F.lit("2030-05-04 10:00:00").cast("timestamp"))
    want = {
        10: ("has_open_booking", 1), 11: ("has_open_booking", 1), 12: ("no_table", None), 13: ("confirmed", 13), 14: ("no_table", None),
        15: ("checked_in", 2), 16: ("no_scheduled_booking", None), 17: ("checked_out", 3), 18: ("not_checked_in", None),
        19: ("accepted", 3), 20: ("item_unavailable", 3), 21: ("invalid_booking", 1), 22: ("cancelled", 1), 23: ("not_allowed", 4),
        24: ("not_found", 99), 25: ("not_found", None), 26: ("not_allowed", 5),
    }
    for gate, changed in ((("member_id",), {}), (("member_id", "service_date"), {11: ("confirmed", 11)})):
        got = {r.command_id: r for r in lifecycle.command_outcomes(commands, state, menu, rtables, masks, gate).collect()}
        assert {c: (r.outcome, r.booking_id) for c, r in got.items()} == {**want, **changed}
        assert got[10].message.endswith("(ID:1) before creating a new one.") and got[17].message is None
        assert sum(r.message is None for r in got.values()) == 1
