"""The booking model under its own relation and column names: exports in, views out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatledger.operators import billing
from seatledger.operators.changes import with_defaults
from seatledger.schemas import DEFAULTS, TABLES
from seatledger.sources.tables import Database, normalise

# Relation names of the model -> tables here.
RELATIONS = {
    "restaurants": "restaurant",
    "RTables": "rtable",
    "Employees": "employee",
    "time_slots": "time_slot",
    "Members": "member",
    "Bookings": "booking",
    "TableStatus": "table_status",
    "BookingStatus": "booking_status",
    "MenuItems": "item",
    "restaurantMenu": "menu",
    "Orders": "order_line",
    "Billing": "billing",
    "PastBookings": "past_booking",
    "WorkShifts": "shift",
    "programLogs": "program_log",
}
# Column names of the model where ours differ.
RENAMED = {"item_id": "MenuItem_id", "item_name": "MenuItem_name"}


# Columns the tables here have and the relations do not.
ADDED = {"booking": ("service_date",), "table_status": ("service_date",), "billing": ("booking_id",)}


def read_relation(spark: SparkSession, path: str, name: str, fmt: str, service_date: date) -> DataFrame:
    """One exported relation as a table here: columns by name, text values cast to the schema."""
    wanted = [f for f in TABLES[name].fields if f.name not in ADDED.get(name, ())]
    # Text formats are read as text and cast, without inference; a csv header names the columns.
    if fmt == "csv":
        source = spark.read.option("header", "true").csv(path)
    elif fmt == "json":
        source = spark.read.schema(", ".join(f"{RENAMED.get(f.name, f.name)} string" for f in wanted)).json(path)
    else:
        source = spark.read.format(fmt).load(path)
    present = {c.lower(): c for c in source.columns}
    columns = []
    for field in wanted:
        column = present.get(RENAMED.get(field.name, field.name).lower())
        value = F.col(f"`{column}`") if column else F.lit(None)
        if isinstance(field.dataType, T.BooleanType):
            # Booleans are exported as 0 and 1.
            value = F.lower(value.cast("string")).isin("1", "true")
        columns.append(value.cast(field.dataType).alias(field.name))
    table = source.select(*columns)
    if "service_date" in ADDED.get(name, ()):
        table = table.withColumn("service_date", F.lit(service_date))
    return with_defaults(normalise(table, name), DEFAULTS.get(name, {}))


def load_relations(
    spark: SparkSession, root: str, service_date: date, fmt: str = "csv", suffix: str = ""
) -> Database:
    """Every relation exported below ``root`` as ``{relation}{suffix}``.

    The model's grid stands for one day, ``service_date`` says which. Bills get the booking
    of their order.
    """
    tables = {
        name: read_relation(spark, f"{root.rstrip('/')}/{relation}{suffix}", name, fmt, service_date)
        for relation, name in RELATIONS.items()
    }
    orders = tables["order_line"].select("order_id", "booking_id")
    tables["billing"] = tables["billing"].join(orders, "order_id", "left").select(*TABLES["billing"].names)
    return Database(tables)


def create_views(db: Database) -> list[str]:
    """Register the tables the database has, and a ``BookingTotals`` view of prices and taxes."""
    made = []
    for relation, name in RELATIONS.items():
        try:
            table = getattr(db, name)
        except AttributeError:
            continue
        renamed = table.select(*[F.col(c).alias(RENAMED.get(c, c)) for c in table.columns])
        renamed.createOrReplaceTempView(relation)
        made.append(relation)
    if {"Bookings", "Orders", "MenuItems", "restaurants"} <= set(made):
        totals = billing.booking_totals(db.booking, db.order_line, db.item, db.restaurant)
        totals.createOrReplaceTempView("BookingTotals")
        made.append("BookingTotals")
    return made
