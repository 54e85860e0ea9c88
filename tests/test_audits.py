"""One violation per rule, and NULLs that must not be reported."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import DAY, frame, small_database
from seatledger.operators import audits
from seatledger.plans import registry
from seatledger.sources.star_schema import StarSchema


def found(df):
    return {(r.rule, r.table_name, r.key, r.n) for r in df.collect()}


def test_primary_keys_report_repeats_and_nulls(spark):
    items = spark.createDataFrame([(1,), (1,), (2,), (None,)], "item_id long")
    assert found(audits.audit_primary_keys({"item": items}, only=["item"])) == {
        ("primary_key", "item", "1", 2), ("primary_key", "item", None, 1),
    }


def test_unique_exempts_nulls(spark):
    members = spark.createDataFrame([("a", None), ("a", None), ("b", "x")], "username string, email string")
    assert found(audits.audit_unique({"member": members}, only=["member"], leave_out=["member.phone_number"])) == {("unique:username", "member", "a", 2)}


def test_foreign_keys_exempt_nulls(spark):
    db = small_database(spark)
    bookings = frame(spark, "booking", [
        {"booking_id": 1, "member_id": 1, "restaurant_id": 1, "table_id": 11, "booking_method": "website"},
        {"booking_id": 2, "member_id": 77, "restaurant_id": None, "table_id": 99, "booking_method": "website"},
        {"booking_id": 3, "member_id": 77, "restaurant_id": 2, "table_id": None, "booking_method": "website"},
    ])
    tables = {"booking": bookings, "member": db.member, "restaurant": db.restaurant, "rtable": db.rtable}
    assert found(audits.audit_foreign_keys(tables, only=["booking"], leave_out=["booking.start_time_slot"])) == {
        ("foreign_key:member_id", "booking", "77", 2), ("foreign_key:table_id", "booking", "99", 1),
    }


def test_not_null(spark):
    tables = spark.createDataFrame([(1, None, 4), (2, 3, None), (3, None, 4)], "restaurant_id long, table_number int, capacity int")
    assert found(audits.audit_not_null({"rtable": tables}, only=["rtable"])) == {
        ("not_null:table_number", "rtable", "table_number", 2), ("not_null:capacity", "rtable", "capacity", 1),
    }


def test_enum_domain_ignores_case(spark):
    staff = spark.createDataFrame([("Chef",), (" SERVER ",), ("pilot",), (None,)], "role string")
    assert found(audits.audit_enum_domain({"employee": staff}, only=["employee"])) == {("domain:role", "employee", "pilot", 1)}


def test_type_bounds(spark):
    places = spark.createDataFrame(
        [("x" * 101, Decimal("9.99")), ("ok", Decimal("10.00"))], "restaurant_name string, tax decimal(6,2)"
    )
    rest = [f"restaurant.{c}" for c in ("location", "zip_code", "phone_number", "email")]
    assert found(audits.audit_type_bounds({"restaurant": places}, only=["restaurant"], leave_out=rest)) == {
        ("bounds:restaurant_name", "restaurant", "restaurant_name", 1), ("bounds:tax", "restaurant", "tax", 1),
    }


def test_status_one_to_one(spark):
    bookings = spark.createDataFrame([(1,), (2,), (3,)], "booking_id long")
    status = spark.createDataFrame([(1,), (2,), (2,)], "booking_id long")
    assert found(audits.audit_status_one_to_one(bookings, status)) == {
        ("status_repeated", "booking_status", "2", 2), ("status_missing", "booking", "3", 1),
    }


@pytest.fixture
def states(spark):
    rows = [
        (1, 1, 11, DAY, 3, 2, "scheduled"), (2, 2, 11, DAY, 4, 1, "ongoing"),
        (3, 3, 11, DAY, 4, 1, "cancelled"), (4, 1, 12, DAY, 13, 3, "scheduled"), (5, None, 12, DAY, 1, 0, "ongoing"),
        (6, None, 12, DAY, 2, 1, "ongoing"),
    ]
    return spark.createDataFrame(
        rows,
        "booking_id long, member_id long, table_id long, service_date date, start_time_slot int, "
        "booking_duration int, booking_status string",
    )


def test_double_booking_counts_open_bookings_only(states):
    assert found(audits.audit_double_booking(states)) == {("double_booking", "booking", f"11/{DAY}/4", 2)}


def test_double_booking_looks_past_closing(spark):
    state = spark.createDataFrame(
        [(1, 11, DAY, 14, 3, "scheduled"), (2, 11, DAY, 13, 4, "ongoing"), (3, 11, DAY, 16, 1, "completed")],
        "booking_id long, table_id long, service_date date, start_time_slot int, booking_duration int, booking_status string",
    )
    assert found(audits.audit_double_booking(state)) == {("double_booking", "booking", f"11/{DAY}/{s}", 2) for s in (14, 15, 16)}


def test_slot_overrun_includes_empty_intervals(states):
    assert found(audits.audit_slot_overrun(states)) == {
        ("slot_overrun", "booking", "4", 1), ("slot_overrun", "booking", "5", 1),
    }


def test_member_single_open(states):
    assert found(audits.audit_member_single_open(states)) == {("several_open_bookings", "booking", "1", 2)}


def test_billing_reconciliation(spark):
    state = spark.createDataFrame(
        [(1, "completed"), (2, "completed"), (3, "ongoing"), (4, "completed"), (5, "completed")],
        "booking_id long, booking_status string",
    )
    bills = spark.createDataFrame(
        [(1, Decimal("5.00"), "paid"), (2, Decimal("5.00"), "pending"), (3, Decimal("5.00"), "paid"),
         (4, Decimal("4.00"), "paid")],
        "booking_id long, total_amount decimal(18,2), payment_status string",
    )
    prices = spark.createDataFrame(
        [(1, Decimal("5.00")), (2, Decimal("5.00")), (3, Decimal("5.00")), (4, Decimal("5.00")), (5, None)],
        "booking_id long, price decimal(18,2)",
    )
    assert found(audits.audit_billing_reconciliation(state, bills, prices)) == {
        ("payment_status_wrong", "billing", "2", 1), ("payment_status_wrong", "billing", "3", 1),
        ("bills_do_not_add_up", "billing", "4", 1),
    }


def test_registered_audits_read_the_bills(spark, sf_dir):
    db = StarSchema(spark, sf_dir)
    bill = "order_id long, total_amount decimal(12,2), payment_status string"
    db.billing = spark.createDataFrame([(-1, Decimal("1.00"), "owed"), (-1, Decimal("100000000.00"), None)], bill)
    for audit, want in {
        registry.audit_primary_keys: {("primary_key", "billing", "-1", 2)},
        registry.audit_unique: {("unique:order_id", "billing", "-1", 2)},
        registry.audit_foreign_keys: {("foreign_key:order_id", "billing", "-1", 2)},
        registry.audit_not_null: {("not_null:payment_status", "billing", "payment_status", 1)},
        registry.audit_enum_domain: {("domain:payment_status", "billing", "owed", 1)},
        registry.audit_type_bounds: {("bounds:total_amount", "billing", "total_amount", 1)},
    }.items():
        assert found(audit(db).where("table_name = 'billing'")) == want


def test_nothing_to_report_on_a_clean_database(spark):
    tables = dict(small_database(spark).tables())
    # Grid cells refer to slots, of which the small database has none.
    slots = ["booking.start_time_slot", "shift.start_time_slot", "table_status.slot_id"]
    for audit in (audits.audit_primary_keys, audits.audit_unique, audits.audit_foreign_keys,
                  audits.audit_not_null, audits.audit_enum_domain, audits.audit_type_bounds, audits.audit_keys):
        assert found(audit(tables, leave_out=slots)) == set()


def test_a_declared_rule_without_its_table_is_an_error(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, item_name string")
    for audit in (audits.audit_primary_keys, audits.audit_unique, audits.audit_foreign_keys,
                  audits.audit_not_null, audits.audit_enum_domain, audits.audit_type_bounds):
        with pytest.raises(ValueError, match="not there|needs"):
            audit({"item": items})
    with pytest.raises(ValueError, match="item.price"):
        audits.audit_type_bounds({"item": items}, only=["item"])


def test_key_rules_scan_every_table_once(spark, tmp_path):
    names = ("rtable", "restaurant", "booking", "member", "time_slot")
    for name, df in small_database(spark).tables().items():
        if name in names:
            df.write.parquet(str(tmp_path / name))
    tables = {n: spark.read.parquet(str(tmp_path / n)) for n in names}
    plan = audits.audit_keys(tables, only=["rtable", "booking"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == len(names) and "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_column_rules_ride_on_a_write(spark, tmp_path):
    from seatledger.plans import day

    db = small_database(spark)
    db = db.replace(rtable=db.rtable.withColumn("capacity", F.when(F.col("table_id") != 11, F.col("capacity"))))
    watch = audits.ColumnWatch({**audits.not_null_tests(), **audits.bounds_tests()})
    settled = day.settle_to(db, str(tmp_path / "v2"), watch)
    assert found(watch.findings(spark)) == {("not_null:capacity", "rtable", "capacity", 1)}
    assert settled.rtable.count() == db.rtable.count()
