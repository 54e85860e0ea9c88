"""The ten analytical reports, with intent variants where the written form misses its comment.

Every grouped report aggregates the fact table on its own key first and joins the
dimension to the aggregate. The partial aggregate runs before the shuffle, so a
restaurant or item holding a third of the facts costs no more than any other, and the
dimension joins a table of its own size instead of the facts.

A mean is an exact sum divided once by a count. Every limit has a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatledger.functions.expressions import exact_mean, from_cents, to_cents
from seatledger.operators import billing as bills


def _rows():
    return F.count(F.lit(1)).cast("bigint")


def active_member_website_bookings(db) -> DataFrame:
    """Q1: bookings active members made on the website, with the restaurant."""
    members = db.members_in("active").select(
        "member_id", "first_name", "last_name", "email"
    )
    bookings = db.booking.where(F.col("booking_method") == "website").select(
        "member_id", "restaurant_id", "booking_method"
    )
    places = db.restaurant.select("restaurant_id", "restaurant_name", "location")
    return (
        bookings.join(members, "member_id").join(places, "restaurant_id")
        .select("first_name", "last_name", "email", "booking_method", "restaurant_name", "location")
    )


def _mean_by_restaurant(amounts: DataFrame, db) -> DataFrame:
    """Mean of ``amount`` per restaurant; joins the name after the aggregate."""
    sums = amounts.groupBy("restaurant_id").agg(
        from_cents(F.sum(to_cents(F.col("amount")))).alias("total"), F.count("amount").alias("n")
    )
    return sums.join(db.restaurant.select("restaurant_id", "restaurant_name"), "restaurant_id").select(
        "restaurant_id", "restaurant_name",
        exact_mean(F.col("total"), F.col("n")).alias("avg_revenue_per_booking"),
    )


def avg_revenue_as_written(db) -> DataFrame:
    """Q2 as written: a bill counts for the booking whose id equals the bill's order id."""
    bill = db.billing.select(F.col("order_id").alias("booking_id"), F.col("total_amount").alias("amount"))
    return _mean_by_restaurant(db.booking.select("booking_id", "restaurant_id").join(bill, "booking_id"), db)


def avg_revenue_per_booking(db) -> DataFrame:
    """Q2 intent: bills summed per booking, then averaged over bookings that have one."""
    spent = bills.line_sums(db.order_line, db.item).withColumnRenamed("price", "amount")
    return _mean_by_restaurant(db.booking.select("booking_id", "restaurant_id").join(spent, "booking_id"), db)


def top_items_by_orders(db, k: int = 15) -> DataFrame:
    """Q3: items with the most order lines."""
    lines = db.order_line.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(
        _rows().alias("total_orders")
    )
    return (
        lines.join(db.item.select("item_id", "item_name"), "item_id")
        .orderBy(F.desc("total_orders"), "item_id")
        .limit(k)
        .select("item_id", "item_name", "total_orders")
    )


def member_booking_summary(db) -> DataFrame:
    """Q4: bookings and cancellations per member, members without bookings included."""
    per_member = db.booking_state.groupBy("member_id").agg(
        _rows().alias("n"), F.count_if(F.col("booking_status") == "cancelled").alias("c")
    )
    zero = F.lit(0).cast("bigint")
    return db.member.select("member_id", "username", "cancellation_penalty").join(
        per_member, "member_id", "left"
    ).select(
        "member_id", "username",
        F.coalesce("n", zero).alias("total_bookings"),
        F.coalesce("c", zero).alias("total_cancellations"),
        "cancellation_penalty",
    )


def high_penalty_bookings(db, above: int = 4) -> DataFrame:
    """Q5: bookings of members whose penalty exceeds a threshold."""
    members = db.members_owing(above).select(
        "member_id", "username", "cancellation_penalty"
    )
    return db.booking.select("booking_id", "member_id", "start_time_slot", "booking_method").join(
        members, "member_id"
    ).select("username", "booking_id", "start_time_slot", "booking_method", "cancellation_penalty")


def _by_restaurant_name(per_id: DataFrame, db, **sums: str) -> DataFrame:
    """Merge per-id sums of restaurants that share a name, as grouping by name does."""
    named = per_id.join(db.restaurant.select("restaurant_id", "restaurant_name"), "restaurant_id")
    return named.groupBy("restaurant_name").agg(*[F.sum(c).alias(name) for name, c in sums.items()])


def avg_duration_top10(db, k: int = 10) -> DataFrame:
    """Q6: restaurants with the longest mean booking."""
    per_id = db.booking.groupBy("restaurant_id").agg(
        F.sum("booking_duration").alias("s"), F.count("booking_duration").alias("n")
    )
    return (
        _by_restaurant_name(per_id, db, s="s", n="n")
        .select("restaurant_name", exact_mean(F.col("s"), F.col("n")).alias("avg_duration"))
        .orderBy(F.desc_nulls_last("avg_duration"), "restaurant_name")
        .limit(k)
    )


def _mean_total_by_item(db, per_line: bool) -> DataFrame:
    """Mean completed-booking total by item name, over order lines or over (booking, item) pairs."""
    active = db.members_in("active").select("member_id")
    visits = (
        db.bookings_in("completed")
        .select("booking_id", "member_id", "restaurant_id")
        .join(active, "member_id", "left_semi")
        .select("booking_id", "restaurant_id")
    )
    # One row per (booking, item) serves both the totals and the attribution; the totals are a
    # window over the booking, so the baskets are made once.
    baskets = (
        db.order_line.select("booking_id", "item_id", "quantity")
        .join(visits, "booking_id")
        .groupBy("booking_id", "restaurant_id", "item_id")
        .agg(_rows().alias("n_lines"), F.sum("quantity").cast("bigint").alias("quantity"))
    )
    priced = bills.with_prices(baskets, db.item, "left").join(db.restaurant.select("restaurant_id", "tax"), "restaurant_id", "left")
    weight = F.col("n_lines") if per_line else F.lit(1).cast("bigint")
    totals = bills.total_columns(priced, "item_id", weight.alias("weight"))
    per_item = totals.groupBy("item_id").agg(
        F.sum((F.col("total_price_after_tax") * F.col("weight")).cast("decimal(28,2)")).alias("s"),
        F.sum(F.when(F.col("total_price_after_tax").isNotNull(), F.col("weight"))).alias("n"),
    )
    return (
        per_item.join(db.item.select("item_id", "item_name"), "item_id")
        .groupBy("item_name")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .select("item_name", exact_mean(F.col("s"), F.col("n")).alias("avg_total_price_after_tax"))
    )


def avg_total_by_item_active(db) -> DataFrame:
    """Q7 as written: the booking total counts once per order line of the item."""
    return _mean_total_by_item(db, per_line=True)


def avg_total_by_item_active_dedup(db) -> DataFrame:
    """Q7 intent: the booking total counts once per item however often it was ordered."""
    return _mean_total_by_item(db, per_line=False)


def completion_ratio_top3(db, k: int = 3) -> DataFrame:
    """Q8: restaurants with the highest share of completed bookings."""
    known = db.booking_state.where(F.col("booking_status").isNotNull())
    per_id = known.groupBy("restaurant_id").agg(
        F.count_if(F.col("booking_status") == "completed").alias("done"), _rows().alias("n")
    )
    return (
        _by_restaurant_name(per_id, db, done="done", n="n")
        .select("restaurant_name", exact_mean(F.col("done"), F.col("n")).alias("completion_ratio"))
        .orderBy(F.desc("completion_ratio"), "restaurant_name")
        .limit(k)
    )


def top_servers_global(db, k: int = 10) -> DataFrame:
    """Q9 as written: bookings of the restaurants a server is rostered at, one global limit.

    Every shift of a server meets every booking of its restaurant, so the count is the
    restaurant's bookings summed over shifts; no pair is ever formed.
    """
    per_restaurant = db.booking.groupBy("restaurant_id").agg(_rows().alias("n"))
    servers = db.employee.where(F.col("role") == "server").select("employee_id", "employee_name")
    places = db.restaurant.select("restaurant_id", "restaurant_name")
    return (
        db.shift.select("employee_id", "restaurant_id")
        .join(servers, "employee_id")
        .join(per_restaurant.join(places, "restaurant_id"), "restaurant_id")
        .groupBy("restaurant_name", "employee_name")
        .agg(F.sum("n").cast("bigint").alias("total_bookings_served"))
        .orderBy("restaurant_name", F.desc("total_bookings_served"), "employee_name")
        .limit(k)
    )


def top_server_per_restaurant(db) -> DataFrame:
    """Q9 intent: in each restaurant the server who served most, by the booking's employee."""
    servers = db.employee.where(F.col("role") == "server").select("employee_id", "employee_name")
    served = (
        db.booking_state.where(F.col("employee_id").isNotNull())
        .groupBy("restaurant_id", "employee_id")
        .agg(_rows().alias("n"))
        .join(servers, "employee_id")
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), "employee_id", "employee_name")).alias("best")
    return (
        served.groupBy("restaurant_id").agg(best)
        .join(db.restaurant.select("restaurant_id", "restaurant_name"), "restaurant_id")
        .select(
            "restaurant_id", "restaurant_name",
            F.col("best.employee_id").alias("employee_id"),
            F.col("best.employee_name").alias("employee_name"),
            (-F.col("best.rank")).alias("total_bookings_served"),
        )
    )


def busiest_slots(db) -> DataFrame:
    """Q10: bookings per start time, busiest first; unused slots are absent."""
    per_slot = db.booking.groupBy(F.col("start_time_slot").alias("slot_id")).agg(
        _rows().alias("total_bookings")
    )
    return (
        per_slot.join(db.time_slot, "slot_id")
        .groupBy("start_time").agg(F.sum("total_bookings").alias("total_bookings"))
        .orderBy(F.desc("total_bookings"), "start_time")
    )
