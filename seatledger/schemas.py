"""Explicit schemas, value domains and the foreign-key graph of the booking model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_long, _int, _str = T.LongType(), T.IntegerType(), T.StringType()
_ts, _bool, _date = T.TimestampType(), T.BooleanType(), T.DateType()

# Prices are stored wider than the two digits after a three-digit integer part that a menu
# needs: with ANSI casts an overflow raises, so amounts are widened where they are read.
TABLES: dict[str, T.StructType] = {
    "restaurant": _struct(
        ("restaurant_id", _long, False), ("restaurant_name", _str), ("location", _str),
        ("zip_code", _str), ("phone_number", _str), ("email", _str), ("tax", T.DecimalType(3, 2)),
    ),
    "rtable": _struct(
        ("table_id", _long, False), ("restaurant_id", _long, False),
        ("table_number", _int, False), ("capacity", _int, False),
    ),
    "employee": _struct(
        ("employee_id", _long, False), ("employee_name", _str), ("phone_number", _str),
        ("email", _str), ("username", _str), ("role", _str, False),
    ),
    "time_slot": _struct(("slot_id", _int, False), ("start_time", _str)),
    "member": _struct(
        ("member_id", _long, False), ("customer_id", _long), ("username", _str),
        ("first_name", _str), ("last_name", _str), ("email", _str), ("phone_number", _str),
        ("login_method", _str, False), ("member_status", _str),
        ("cancellation_penalty", T.DecimalType(10, 2)),
    ),
    "booking": _struct(
        ("booking_id", _long, False), ("member_id", _long), ("restaurant_id", _long),
        ("table_id", _long), ("start_time_slot", _int), ("booking_duration", _int),
        ("booking_created", _ts), ("booking_method", _str, False), ("service_date", _date),
    ),
    "table_status": _struct(
        ("table_id", _long), ("service_date", _date), ("slot_id", _int),
        ("booking_id", _long), ("status", _str),
    ),
    "booking_status": _struct(
        ("booking_id", _long), ("booking_status", _str, False), ("out_time", _str),
        ("employee_id", _long), ("cancelled_on", _ts), ("last_activity", _ts),
    ),
    "item": _struct(
        ("item_id", _long, False), ("item_name", _str), ("serving_description", _str),
        ("price", T.DecimalType(10, 2)),
    ),
    "menu": _struct(
        ("restaurant_menu_id", _long), ("restaurant_id", _long), ("item_id", _long),
        ("availability", _bool),
    ),
    "order_line": _struct(
        ("order_id", _long, False), ("booking_id", _long), ("item_id", _long),
        ("quantity", _int), ("order_time", _ts),
    ),
    "billing": _struct(
        ("order_id", _long), ("booking_id", _long), ("total_amount", MONEY),
        ("payment_status", _str, False), ("payment_date", _ts),
    ),
    "past_booking": _struct(
        ("booking_id", _long), ("total_price", MONEY), ("total_tax", MONEY),
        ("total_price_after_tax", MONEY), ("booking_created", _ts),
    ),
    "shift": _struct(
        ("shift_id", _long, False), ("employee_id", _long), ("restaurant_id", _long),
        ("start_time_slot", _int), ("shift_duration", _int),
    ),
    "program_log": _struct(("log_id", _long, False), ("log_timestamp", _ts), ("message", _str)),
    "command": _struct(
        ("command_id", _long, False), ("ts", _ts, False), ("command", _str, False),
        ("member_id", _long), ("booking_id", _long), ("restaurant_id", _long),
        ("start_time_slot", _int), ("booking_duration", _int), ("booking_method", _str),
        ("item_id", _long), ("quantity", _int), ("service_date", _date),
    ),
}

# The value domains the model declares, lower-cased.
DOMAINS: dict[tuple[str, str], tuple[str, ...]] = {
    ("employee", "role"): ("chef", "server", "manager"),
    ("member", "login_method"): ("website", "walk-in", "phone call"),
    ("member", "member_status"): ("just member", "active", "cancelled"),
    ("booking", "booking_method"): ("website", "walk-in", "phone call"),
    ("table_status", "status"): ("occupied", "vacant"),
    ("booking_status", "booking_status"): ("scheduled", "ongoing", "completed", "cancelled"),
    ("billing", "payment_status"): ("pending", "paid"),
}

# The column defaults the model declares.
DEFAULTS: dict[str, dict[str, object]] = {
    "member": {"cancellation_penalty": 0},
    "table_status": {"status": "vacant"},
    "booking_status": {"booking_status": "scheduled"},
    "billing": {"payment_status": "pending"},
}

# The columns whose declared default is the current time.
NOW_DEFAULTS: dict[str, tuple[str, ...]] = {
    "booking": ("booking_created",),
    "booking_status": ("last_activity",),
    "order_line": ("order_time",),
    "program_log": ("log_timestamp",),
}

# Declared text lengths.
TEXT_LIMITS: dict[tuple[str, str], int] = {
    ("restaurant", "restaurant_name"): 100,
    ("restaurant", "location"): 255,
    ("restaurant", "zip_code"): 10,
    ("restaurant", "phone_number"): 12,
    ("restaurant", "email"): 100,
    ("employee", "employee_name"): 50,
    ("employee", "phone_number"): 12,
    ("employee", "email"): 100,
    ("employee", "username"): 50,
    ("member", "username"): 50,
    ("member", "first_name"): 50,
    ("member", "last_name"): 50,
    ("member", "email"): 100,
    ("member", "phone_number"): 20,
    ("item", "item_name"): 255,
    ("program_log", "message"): 150,
}

# Declared decimal (precision, scale).
DECIMAL_LIMITS: dict[tuple[str, str], tuple[int, int]] = {
    ("restaurant", "tax"): (3, 2),
    ("item", "price"): (5, 2),
    ("billing", "total_amount"): (10, 2),
    ("past_booking", "total_price"): (10, 2),
    ("past_booking", "total_tax"): (10, 2),
    ("past_booking", "total_price_after_tax"): (10, 2),
}

# Keys, unique and mandatory columns, references.
PRIMARY_KEYS: dict[str, str] = {
    "restaurant": "restaurant_id",
    "rtable": "table_id",
    "employee": "employee_id",
    "time_slot": "slot_id",
    "member": "member_id",
    "booking": "booking_id",
    "item": "item_id",
    "menu": "restaurant_menu_id",
    "order_line": "order_id",
    "billing": "order_id",
    "shift": "shift_id",
    "program_log": "log_id",
}

UNIQUE_COLUMNS: tuple[tuple[str, str], ...] = (
    ("member", "username"),
    ("member", "email"),
    ("member", "phone_number"),
    ("item", "item_name"),
    ("billing", "order_id"),
)

NOT_NULL_COLUMNS: tuple[tuple[str, str], ...] = (
    ("rtable", "restaurant_id"),
    ("rtable", "table_number"),
    ("rtable", "capacity"),
    ("employee", "role"),
    ("member", "login_method"),
    ("booking", "booking_method"),
    ("booking_status", "booking_status"),
    ("billing", "payment_status"),
)


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_key: str


FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("rtable", "restaurant_id", "restaurant", "restaurant_id"),
    ForeignKey("booking", "member_id", "member", "member_id"),
    ForeignKey("booking", "restaurant_id", "restaurant", "restaurant_id"),
    ForeignKey("booking", "table_id", "rtable", "table_id"),
    ForeignKey("booking", "start_time_slot", "time_slot", "slot_id"),
    ForeignKey("table_status", "table_id", "rtable", "table_id"),
    ForeignKey("table_status", "booking_id", "booking", "booking_id"),
    ForeignKey("table_status", "slot_id", "time_slot", "slot_id"),
    ForeignKey("booking_status", "booking_id", "booking", "booking_id"),
    ForeignKey("menu", "restaurant_id", "restaurant", "restaurant_id"),
    ForeignKey("menu", "item_id", "item", "item_id"),
    ForeignKey("order_line", "booking_id", "booking", "booking_id"),
    ForeignKey("order_line", "item_id", "item", "item_id"),
    ForeignKey("billing", "order_id", "order_line", "order_id"),
    ForeignKey("past_booking", "booking_id", "booking", "booking_id"),
    ForeignKey("shift", "employee_id", "employee", "employee_id"),
    ForeignKey("shift", "restaurant_id", "restaurant", "restaurant_id"),
    ForeignKey("shift", "start_time_slot", "time_slot", "slot_id"),
)
