"""Booking tables derived from a supplier/customer/orders/lineitem star schema.

Lets every operator run on generic star-schema data: suppliers act as restaurants,
customers as members, orders as bookings, line items as order lines, parts as menu
items and events as the command stream.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger.functions.expressions import SLOTS_PER_DAY, int_div
from seatledger.operators.ordering import dense_keys
from seatledger.sources.generators import time_slots
from seatledger.sources.tables import Database

TABLES_PER_RESTAURANT = 10
STAFF_PER_RESTAURANT = 5
ORDER_STATUS = {"completed": "F", "cancelled": "P", "scheduled": "O", "ongoing": "O"}
SEGMENTS = {"active": ("BUILDING", "MACHINERY"), "cancelled": ("FURNITURE",)}
EVENT_TYPE = {
    "new_booking": "signup", "member_in": "view", "order_food": "click", "member_out": "purchase",
    "cancel_booking": "error",
}
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
# Events are dated in 2024, orders in 1995-2001: shift commands back so the two meet.
COMMAND_MONTHS_BACK = 312


class StarSchema(Database):
    """Lazy booking tables over ``{root}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__({})
        self.spark = spark
        self.root = root.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def _restaurants(self) -> int:
        return self.raw("supplier").count()

    @cached_property
    def _items(self) -> int:
        return self.raw("part").count()

    def _restaurant_of(self, key: Column) -> Column:
        return key % F.lit(self._restaurants).cast("bigint")

    # --- dimensions ------------------------------------------------------------------

    @cached_property
    def restaurant(self) -> DataFrame:
        tax = (F.lit(Decimal("7.50")) + F.lit(Decimal("0.08")) * F.col("n_nationkey")).cast("decimal(3,2)")
        nation = self.raw("nation").select("n_nationkey", "n_name")
        return self.raw("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("restaurant_id"),
            F.col("s_name").alias("restaurant_name"),
            F.col("n_name").alias("location"),
            tax.alias("tax"),
        )

    def members_of(self, customers: DataFrame) -> DataFrame:
        owed = ((-F.col("c_acctbal")).cast("decimal(12,2)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")
        segment, name = F.col("c_mktsegment"), F.col("c_name")
        return customers.select(
            F.col("c_custkey").alias("member_id"),
            F.col("c_custkey").alias("customer_id"),
            name.alias("username"),
            F.substring_index(name, "#", 1).alias("first_name"),
            F.substring_index(name, "#", -1).alias("last_name"),
            F.concat(F.lower(F.regexp_replace(name, "#", ".")), F.lit("@example.com")).alias("email"),
            F.when(segment.isin(*SEGMENTS["active"]), "active")
            .when(segment.isin(*SEGMENTS["cancelled"]), "cancelled")
            .otherwise("just member").alias("member_status"),
            F.when(F.col("c_acctbal") < 0, owed).otherwise(F.lit(0).cast("decimal(10,2)"))
            .alias("cancellation_penalty"),
        )

    @cached_property
    def member(self) -> DataFrame:
        return self.members_of(self.raw("customer"))

    def members_in(self, status: str) -> DataFrame:
        customers = self.raw("customer")
        if status in SEGMENTS:
            customers = customers.where(F.col("c_mktsegment").isin(*SEGMENTS[status]))
        return self.members_of(customers).where(F.col("member_status") == status)

    def members_owing(self, above) -> DataFrame:
        owing = self.raw("customer").where(F.col("c_acctbal") < 0) if above >= 0 else self.raw("customer")
        return self.members_of(owing).where(F.col("cancellation_penalty") > above)

    @cached_property
    def rtable(self) -> DataFrame:
        k = F.explode(F.sequence(F.lit(1), F.lit(TABLES_PER_RESTAURANT))).alias("table_number")
        return self.raw("supplier").select(F.col("s_suppkey").alias("restaurant_id"), k).select(
            (F.col("restaurant_id") * TABLES_PER_RESTAURANT + F.col("table_number")).alias("table_id"),
            "restaurant_id", "table_number", (2 + F.col("table_number") % 3 * 2).alias("capacity"),
        )

    @cached_property
    def time_slot(self) -> DataFrame:
        return time_slots(self.spark)

    @cached_property
    def item(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        )

    @cached_property
    def _staff(self) -> DataFrame:
        k = F.explode(F.sequence(F.lit(0), F.lit(STAFF_PER_RESTAURANT - 1))).alias("k")
        return self.raw("supplier").select(F.col("s_suppkey").alias("restaurant_id"), k).withColumn(
            "employee_id", F.col("restaurant_id") * STAFF_PER_RESTAURANT + F.col("k")
        )

    @cached_property
    def employee(self) -> DataFrame:
        return self._staff.select(
            "employee_id",
            F.concat(F.lit("Employee "), F.col("employee_id").cast("string")).alias("employee_name"),
            F.when(F.col("k") == 0, "chef").when(F.col("k") == 3, "manager").otherwise("server").alias("role"),
        )

    @cached_property
    def shift(self) -> DataFrame:
        return self._staff.select(
            F.col("employee_id").alias("shift_id"), "employee_id", "restaurant_id",
            (1 + F.col("k") % 2).alias("start_time_slot"), (10 - F.col("k") % 2).alias("shift_duration"),
        )

    # --- facts -----------------------------------------------------------------------

    def states_of(self, orders: DataFrame) -> DataFrame:
        """Bookings with their status from raw orders; works on a stream as well."""
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        restaurant = self._restaurant_of(key)
        state = (
            F.when(status == "F", "completed").when(status == "P", "cancelled")
            .when(key % 2 == 0, "ongoing").otherwise("scheduled")
        )
        server = restaurant * STAFF_PER_RESTAURANT + int_div(key, 3) % STAFF_PER_RESTAURANT
        return orders.select(
            key.alias("booking_id"),
            F.col("o_custkey").alias("member_id"),
            restaurant.alias("restaurant_id"),
            (restaurant * TABLES_PER_RESTAURANT + 1 + int_div(key, 11) % TABLES_PER_RESTAURANT).alias("table_id"),
            (1 + int_div(key, 7) % SLOTS_PER_DAY).cast("int").alias("start_time_slot"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("booking_duration"),
            F.when(key % 3 == 0, "website").when(key % 3 == 1, "walk-in").otherwise("phone call")
            .alias("booking_method"),
            F.col("o_orderdate").cast("timestamp").alias("booking_created"),
            F.trunc("o_orderdate", "month").alias("service_date"),
            state.alias("booking_status"),
            F.when(state.isin("ongoing", "completed"), server).alias("employee_id"),
        )

    @cached_property
    def booking_state(self) -> DataFrame:
        """Both live in one row of orders, so no self-join."""
        return self.states_of(self.raw("orders"))

    def bookings_in(self, *statuses: str) -> DataFrame:
        codes = sorted({ORDER_STATUS[s] for s in statuses})
        orders = self.raw("orders").where(F.col("o_orderstatus").isin(*codes))
        return self.states_of(orders).where(F.col("booking_status").isin(*statuses))

    @cached_property
    def booking(self) -> DataFrame:
        return self.booking_state.drop("booking_status", "employee_id")

    @cached_property
    def booking_status(self) -> DataFrame:
        return self.booking_state.select("booking_id", "booking_status", "employee_id")

    def lines_of(self, lineitem: DataFrame) -> DataFrame:
        return lineitem.select(
            F.col("l_orderkey").alias("booking_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    @cached_property
    def order_line(self) -> DataFrame:
        return self.lines_of(self.raw("lineitem"))

    @cached_property
    def numbered_order_line(self) -> DataFrame:
        """Order lines with dense order ids; costs a global sort, so only where ids matter."""
        lines = self.raw("lineitem").select(*LINE_ORDER)
        keyed = dense_keys(lines, LINE_ORDER, "order_id")
        return keyed.select("order_id", *[F.col(c) for c in LINE_ORDER]).select(
            "order_id",
            F.col("l_orderkey").alias("booking_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    @cached_property
    def pending_billing(self) -> DataFrame:
        from seatledger.operators.billing import billing_from_orders

        return billing_from_orders(self.numbered_order_line, self.item)

    @cached_property
    def billing(self) -> DataFrame:
        from seatledger.operators.billing import settle_bills

        return settle_bills(self.pending_billing, self.bookings_in("completed"))

    @cached_property
    def plain_billing(self) -> DataFrame:
        """Bills without their numbers, for questions that don't ask for them: no global sort."""
        from seatledger.operators.billing import priced_lines, settle_bills

        if "billing" in self.__dict__:  # numbered already, or exchanged
            return self.billing
        bills = priced_lines(self.order_line, self.item).select(
            "booking_id", "total_amount", F.lit("pending").alias("payment_status")
        )
        return settle_bills(bills, self.bookings_in("completed"))

    @cached_property
    def menu(self) -> DataFrame:
        listed = self.raw("lineitem").select(
            self._restaurant_of(F.col("l_orderkey")).alias("restaurant_id"), F.col("l_partkey").alias("item_id")
        )
        return listed.distinct().withColumn(
            "availability", F.col("item_id") % 10 != F.col("restaurant_id") % 10
        )

    def commands_of(self, events: DataFrame) -> DataFrame:
        """Booking commands from raw events; works on a stream as well."""
        event, kind = F.col("event_id"), F.col("event_type")
        command = F.coalesce(*[F.when(kind == raw, name) for name, raw in EVENT_TYPE.items()])
        return events.select(
            event.alias("command_id"),
            F.col("ts").cast("timestamp").alias("ts"),
            command.alias("command"),
            F.col("user_id").alias("member_id"),
            F.when(kind.isin("click", "error"), event * 2).alias("booking_id"),
            F.when(kind == "signup", self._restaurant_of(event)).alias("restaurant_id"),
            F.when(kind == "signup", 1 + event % SLOTS_PER_DAY).cast("int").alias("start_time_slot"),
            F.when(kind == "signup", 1 + int_div(event, SLOTS_PER_DAY) % 5).cast("int").alias("booking_duration"),
            F.when(kind == "click", event * 7 % F.lit(self._items).cast("bigint")).alias("item_id"),
            F.when(kind == "click", 1 + event % 4).cast("int").alias("quantity"),
            F.trunc(F.add_months("ts", -COMMAND_MONTHS_BACK), "month").alias("service_date"),
        )

    @cached_property
    def command(self) -> DataFrame:
        return self.commands_of(self.raw("events"))

    def commands_in(self, *kinds: str) -> DataFrame:
        return self.commands_of(self.raw("events").where(F.col("event_type").isin(*[EVENT_TYPE[k] for k in kinds])))

    # --- availability ------------------------------------------------------------------

    @cached_property
    def open_state(self) -> DataFrame:
        return self.bookings_in("scheduled", "ongoing")

    @cached_property
    def masks(self) -> DataFrame:
        """Occupancy by bookings still open."""
        from seatledger.operators.availability import occupancy_masks

        return occupancy_masks(self.open_state)

    @cached_property
    def request(self) -> DataFrame:
        """Cancelled bookings, asked for again in creation order."""
        return self.bookings_in("cancelled").select(
            F.col("booking_id").alias("request_id"), F.col("booking_created").alias("ts"), "member_id",
            "restaurant_id", "service_date", "start_time_slot", "booking_duration",
        )
