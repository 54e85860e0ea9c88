"""Small hand-made inputs; all values are our own."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from seatledger.schemas import TABLES
from seatledger.sources.generators import availability_grid
from seatledger.sources.tables import Database, normalise
from seatledger.schemas import DEFAULTS
from seatledger.operators.changes import with_defaults

DAY = date(2030, 5, 4)
NOON = datetime(2030, 5, 4, 12)


def at(minute: int) -> datetime:
    return NOON + timedelta(minutes=minute)


def frame(spark, table: str, rows: list[dict]):
    schema = TABLES[table]
    df = spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], _nullable(schema))
    return with_defaults(normalise(df, table), DEFAULTS.get(table, {}))


def _nullable(schema):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def small_database(spark) -> Database:
    """Two restaurants with two tables each, four members, a short menu and three employees."""
    from pyspark.sql import functions as F

    rtable = frame(spark, "rtable", [
        {"table_id": 10 * r + n, "restaurant_id": r, "table_number": n, "capacity": 4}
        for r in (1, 2) for n in (1, 2)
    ])
    grid = availability_grid(rtable).withColumn("service_date", F.lit(DAY))
    return Database({
        "restaurant": frame(spark, "restaurant", [
            {"restaurant_id": 1, "restaurant_name": "Fern", "location": "North", "tax": Decimal("8.25")},
            {"restaurant_id": 2, "restaurant_name": "Moss", "location": "South", "tax": Decimal("5.00")},
        ]),
        "rtable": rtable,
        "time_slot": frame(spark, "time_slot", []),
        "employee": frame(spark, "employee", [
            {"employee_id": 1, "employee_name": "Ada", "role": "Server"},
            {"employee_id": 2, "employee_name": "Bo", "role": "CHEF"},
            {"employee_id": 3, "employee_name": "Cy", "role": "server"},
        ]),
        "shift": frame(spark, "shift", [
            {"shift_id": 1, "employee_id": 1, "restaurant_id": 1, "start_time_slot": 1, "shift_duration": 8},
            {"shift_id": 2, "employee_id": 2, "restaurant_id": 1, "start_time_slot": 1, "shift_duration": 8},
            {"shift_id": 3, "employee_id": 3, "restaurant_id": 1, "start_time_slot": 6, "shift_duration": 8},
        ]),
        "member": frame(spark, "member", [
            {"member_id": m, "username": f"user{m}", "first_name": f"F{m}", "last_name": f"L{m}",
             "email": f"u{m}@example.org", "login_method": "Website", "member_status": "Active"}
            for m in (1, 2, 3, 4)
        ]),
        "item": frame(spark, "item", [
            {"item_id": 1, "item_name": "soup", "price": Decimal("4.60")},
            {"item_id": 2, "item_name": "pie", "price": Decimal("7.25")},
            {"item_id": 3, "item_name": "tea", "price": Decimal("2.10")},
        ]),
        "menu": frame(spark, "menu", [
            {"restaurant_menu_id": 1, "restaurant_id": 1, "item_id": 1, "availability": True},
            {"restaurant_menu_id": 2, "restaurant_id": 1, "item_id": 2, "availability": False},
            {"restaurant_menu_id": 3, "restaurant_id": 2, "item_id": 3, "availability": True},
        ]),
        "booking": frame(spark, "booking", []),
        "booking_status": frame(spark, "booking_status", []),
        "table_status": grid.select(*TABLES["table_status"].names),
        "order_line": frame(spark, "order_line", []),
        "billing": frame(spark, "billing", []),
        "past_booking": frame(spark, "past_booking", []),
        "program_log": frame(spark, "program_log", []),
    })


def booking_request(i: int, member: int, restaurant: int, start: int, duration: int, minute: int | None = None):
    return {
        "command_id": i, "ts": at(i if minute is None else minute), "command": "new_booking", "member_id": member,
        "restaurant_id": restaurant, "start_time_slot": start, "booking_duration": duration,
        "booking_method": "Walk-in", "service_date": DAY,
    }
