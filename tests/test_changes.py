from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import DAY, at
from seatledger.operators import availability, billing, changes, staffing
from seatledger.plans import reports
from seatledger.sources import generators
from seatledger.sources.tables import Database


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_apply_changes_can_write_null_and_insert(spark):
    base = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w long")
    new = spark.createDataFrame([(2, None), (3, "c")], "k long, v string")
    assert rows(changes.apply_changes(base, new, ["k"], ["v"]), "k", "w") == [(1, 10), (2, 20)]
    updated = {r.k: (r.v, r.w) for r in changes.apply_changes(base, new, ["k"], ["v"], insert=True).collect()}
    assert updated == {1: ("a", 10), 2: (None, 20), 3: ("c", None)}


def test_latest_change_per_key(spark):
    df = spark.createDataFrame([(1, at(1), "x"), (1, at(3), "z"), (1, at(2), "y"), (2, at(1), "q")],
                               "k long, ts timestamp, v string")
    assert rows(changes.latest_change(df, ["k"], ["ts"]), "k", "v") == [(1, "z"), (2, "q")]


def test_occupy_then_release(spark):
    booking = spark.createDataFrame(
        [(1, 11, DAY, 2, 2), (2, 11, DAY, 3, 1), (3, 12, DAY, 1, 1)],
        "booking_id long, table_id long, service_date date, start_time_slot int, booking_duration int",
    )
    grid = spark.createDataFrame(
        [(t, DAY, s, None, "vacant") for t in (11, 12) for s in (1, 2, 3)],
        "table_id long, service_date date, slot_id int, booking_id long, status string",
    )
    taken = changes.occupy_slots(grid, booking)
    cells = {(r.table_id, r.slot_id): (r.booking_id, r.status) for r in taken.collect()}
    assert cells[11, 3] == (2, "occupied") and cells[11, 2] == (1, "occupied") and cells[12, 2] == (None, "vacant")
    status = spark.createDataFrame([(1, "cancelled"), (2, "completed"), (3, "ongoing")],
                                   "booking_id long, booking_status string")
    freed = {(r.table_id, r.slot_id): (r.booking_id, r.status) for r in changes.release_slots(taken, status).collect()}
    assert freed[11, 2] == (None, "vacant") and freed[11, 3] == (2, "vacant") and freed[12, 1] == (3, "occupied")
    assert len(freed) == 6
    # The search reads the status, so the stale id does not block.
    masks = {r.table_id: r.occupied_mask for r in availability.grid_masks(changes.release_slots(taken, status)).collect()}
    assert masks == {12: 1}


def test_occupied_cells_are_those_of_the_grid(spark):
    """A packed grid gives the cells of an unpacked one; cells that no slot of the day covers stay as they are."""
    booking = spark.createDataFrame(
        [(1, 11, DAY, 13, 5), (2, 11, DAY, 14, 1), (None, 12, DAY, 2, 1), (4, 12, DAY, 5, 0), (5, 12, DAY, -1, 4), (6, None, DAY, 1, 9)],
        "booking_id long, table_id long, service_date date, start_time_slot int, booking_duration int",
    )
    cells = ("table_id", "slot_id", "booking_id", "status")
    plain = changes.occupy_slots(generators.booked_days_grid(booking.where("table_id is not null")), booking)
    got = {r[:2]: r[2:] for r in plain.select(*cells).collect()}
    taken = {k: v for k, v in got.items() if v[1] == "occupied"}
    assert len(got) == 28
    assert taken == {(11, 13): (1, "occupied"), (11, 14): (2, "occupied"), (12, 1): (5, "occupied"), (12, 2): (5, "occupied")}
    packed = changes.occupy_slots(generators.booked_days_grid(booking.where("table_id is not null"), packed=True), booking)
    assert packed.columns == plain.columns and packed.exceptAll(plain).isEmpty() and plain.exceptAll(packed).isEmpty()
    # Cells beyond the day, and a booking without id that takes a cell.
    odd = spark.createDataFrame([(11, DAY, 15, 9, "old"), (12, DAY, None, 8, "old"), (13, DAY, 2, 7, "old")],
                                "table_id long, service_date date, slot_id int, booking_id long, status string")
    assert sorted(changes.occupy_slots(odd, booking).collect(), key=str) == sorted(odd.collect(), key=str)
    nameless = changes.occupy_slots(odd.where("table_id = 13"), booking.where("booking_id is null").withColumn("table_id", F.lit(13)))
    assert [r[3:] for r in nameless.collect()] == [(None, "occupied")]


def test_a_booking_holds_the_slots_past_closing_too(spark):
    booking = spark.createDataFrame(
        [(1, 11, DAY, 13, 5), (2, 11, DAY, 14, 9), (3, 12, DAY, 2, 0), (4, 12, DAY, 2, None), (5, 12, DAY, None, 2)],
        "booking_id long, table_id long, service_date date, start_time_slot int, booking_duration int",
    )
    held = rows(changes.booking_cells(booking), "booking_id", "slot_id")
    assert held == [(1, s) for s in range(13, 18)] + [(2, s) for s in range(14, 23)]


def test_touch_keeps_the_later_time(spark):
    status = spark.createDataFrame([(1, at(5)), (2, None)], "booking_id long, last_activity timestamp")
    seen = spark.createDataFrame([(1, at(3)), (2, at(4)), (2, at(6))], "booking_id long, ts timestamp")
    got = changes.touch(status, seen).selectExpr("booking_id", "unix_timestamp(last_activity) t").collect()
    later = dict((r.booking_id, r.t) for r in got)
    want = spark.createDataFrame([(1, at(5)), (2, at(6))], "b long, t timestamp").selectExpr("b", "unix_timestamp(t) t")
    assert later == {r.b: r.t for r in want.collect()}


def test_cascade_follows_every_path_and_keeps_nulls(spark):
    tables = {
        "restaurant": spark.createDataFrame([(1,), (2,)], "restaurant_id long"),
        "rtable": spark.createDataFrame([(11, 1), (21, 2)], "table_id long, restaurant_id long"),
        # Booking 3 sits at restaurant 2 but on a table of restaurant 1.
        "booking": spark.createDataFrame(
            [(1, 1, 11), (2, 2, 21), (3, 2, 11), (4, None, None)],
            "booking_id long, restaurant_id long, table_id long"),
        "order_line": spark.createDataFrame([(100, 1), (101, 2), (102, 3), (103, None)], "order_id long, booking_id long"),
        "billing": spark.createDataFrame([(100,), (101,), (102,), (103,)], "order_id long"),
    }
    left = changes.cascade_delete(tables, "restaurant", spark.createDataFrame([(1,)], "restaurant_id long"))
    assert rows(left["restaurant"], "restaurant_id") == [(2,)]
    assert rows(left["rtable"], "table_id") == [(21,)]
    assert rows(left["booking"], "booking_id") == [(2,), (4,)]
    assert rows(left["order_line"], "order_id") == [(101,), (103,)]
    assert rows(left["billing"], "order_id") == [(101,), (103,)]


def test_totals_round_tax_before_adding(spark):
    items = spark.createDataFrame([(1, Decimal("10.10")), (2, Decimal("0.05"))], "item_id long, price decimal(10,2)")
    lines = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (2, 2, 1)], "booking_id long, item_id long, quantity int")
    places = spark.createDataFrame([(5, Decimal("5.50"))], "restaurant_id long, tax decimal(3,2)")
    booking = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "booking_id long, restaurant_id long")
    got = {r.booking_id: (r.total_price, r.total_tax, r.total_price_after_tax)
           for r in billing.booking_totals(booking, lines, items, places).collect()}
    # 30.30 * 5.5% = 1.6665 -> 1.67; 0.05 * 5.5% = 0.00275 -> 0.00
    assert got == {
        1: (Decimal("30.30"), Decimal("1.67"), Decimal("31.97")),
        2: (Decimal("0.05"), Decimal("0.00"), Decimal("0.05")),
        3: (None, None, None),
    }


def test_prices_of_baskets_with_unknown_items(spark):
    baskets = spark.createDataFrame([(1, 10, 2), (1, 11, 1), (1, 99, 5), (2, 99, 1)], "booking_id long, item_id long, quantity long")
    items = spark.createDataFrame([(10, Decimal("1.25")), (11, Decimal("3.00")), (12, None)], "item_id long, price decimal(10,2)")
    kept = billing.with_prices(baskets, items, "left").collect()
    assert {(r["booking_id"], r["item_id"], r["price"]) for r in kept} == {
        (1, 10, Decimal("5.50")), (1, 11, Decimal("5.50")), (1, 99, Decimal("5.50")), (2, 99, None)
    }
    assert {(r["booking_id"], r["item_id"]) for r in billing.with_prices(baskets, items).collect()} == {(1, 10), (1, 11)}


def test_available_tables_edges(spark):
    rtable = spark.createDataFrame([(1, 11), (1, 12)], "restaurant_id long, table_id long")
    held = spark.createDataFrame(
        [(1, 11, DAY, 5, 2), (2, 12, DAY, 13, 9), (3, 12, DAY, 2, 0)],
        "booking_id long, table_id long, service_date date, start_time_slot int, booking_duration int",
    )
    ask = spark.createDataFrame(
        [(1, 1, DAY, 4, 1), (2, 1, DAY, 4, 2), (3, 1, DAY, 14, 1), (4, 1, DAY, 14, 2), (5, 1, DAY, 3, 0),
         (6, 7, DAY, 1, 1), (7, 1, DAY, 1, 14)],
        "request_id long, restaurant_id long, service_date date, start_time_slot int, booking_duration int",
    )
    found = availability.find_available_table(ask, rtable, availability.occupancy_masks(held))
    assert {r.request_id: (r.table_id, r.available_count) for r in found.collect()} == {
        1: (11, 2), 2: (12, 1), 3: (11, 1), 4: (None, 0), 5: (None, 0), 6: (None, 0), 7: (None, 0),
    }


def test_snapshot_choice_and_eligibility(spark):
    shifts = spark.createDataFrame([(1, 5, 1), (1, 6, 1), (1, 7, 8)], "restaurant_id long, employee_id long, start_time_slot int")
    status = spark.createDataFrame([(50, "ongoing", 5), (51, "ongoing", 6), (52, "completed", 7)],
                                   "booking_id long, booking_status string, employee_id long")
    booking = spark.createDataFrame([(1, 1, 2), (2, 1, 9), (3, 2, 9)], "booking_id long, restaurant_id long, start_time_slot int")
    got = {r.booking_id: r.employee_id for r in staffing.assign_staff_snapshot(booking, shifts, status).collect()}
    assert got == {1: 5, 2: 7, 3: None}
    can = {r.booking_id: (r.eligible, r.first_employee_id) for r in staffing.eligible_staff(booking, shifts).collect()}
    assert can == {1: (2, 5), 2: (3, 5), 3: (0, None)}
    load = {r.employee_id: r.load for r in staffing.staff_load(shifts, status).collect()}
    assert load == {5: 1, 6: 1, 7: None}


@pytest.fixture
def named(spark):
    """Two restaurants share a name; report 6 and 8 group by it, report 2 does not."""
    return Database({
        "restaurant": spark.createDataFrame([(1, "Fern", "N"), (2, "Fern", "S"), (3, "Moss", "S")],
                                            "restaurant_id long, restaurant_name string, location string"),
        "booking": spark.createDataFrame([(1, 1, 2, 1), (2, 2, 4, 1), (3, 3, 3, 2), (4, 3, None, 2)],
                                         "booking_id long, restaurant_id long, booking_duration int, member_id long"),
        "booking_status": spark.createDataFrame([(1, "completed", 1), (2, "cancelled", 1), (3, "completed", None), (4, "completed", None)],
                                                "booking_id long, booking_status string, employee_id long"),
        "member": spark.createDataFrame([(1, "a", Decimal("0")), (2, "b", Decimal("5")), (3, "c", Decimal("0"))],
                                        "member_id long, username string, cancellation_penalty decimal(10,2)"),
        "billing": spark.createDataFrame([(1, Decimal("3.00")), (4, Decimal("5.00")), (9, Decimal("7.00"))],
                                         "order_id long, total_amount decimal(18,2)"),
        "employee": spark.createDataFrame([(1, "Ada", "server"), (2, "Bo", "server"), (3, "Cy", "chef")],
                                          "employee_id long, employee_name string, role string"),
        "shift": spark.createDataFrame([(1, 1), (1, 1), (2, 1), (3, 1)], "employee_id long, restaurant_id long"),
    })


def test_reports_group_by_name(named):
    assert rows(reports.avg_duration_top10(named), "restaurant_name", "avg_duration") == [("Fern", 3.0), ("Moss", 3.0)]
    assert rows(reports.completion_ratio_top3(named), "restaurant_name", "completion_ratio") == [("Fern", 0.5), ("Moss", 1.0)]


def test_bill_attributed_by_shared_number(named):
    assert rows(reports.avg_revenue_as_written(named), "restaurant_id", "avg_revenue_per_booking") == [(1, 3.0), (3, 5.0)]


def test_member_without_bookings_is_listed(named):
    assert rows(reports.member_booking_summary(named), "member_id", "total_bookings", "total_cancellations") == [
        (1, 2, 1), (2, 2, 0), (3, 0, 0),
    ]


def test_servers_count_once_per_shift(named):
    assert rows(reports.top_servers_global(named), "employee_name", "total_bookings_served") == [("Ada", 2), ("Bo", 1)]
    assert rows(reports.top_server_per_restaurant(named), "restaurant_id", "employee_name", "total_bookings_served") == [
        (1, "Ada", 1), (2, "Ada", 1),
    ]
