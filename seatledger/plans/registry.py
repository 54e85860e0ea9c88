"""Every operator as a named query over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger.operators import audits, billing, changes, lifecycle, staffing
from seatledger.operators.allocate import allocate_bookings
from seatledger.operators.availability import available_tables, find_available_table
from seatledger.operators.ordering import dense_keys
from seatledger.plans import reports
from seatledger.schemas import DEFAULTS, FOREIGN_KEYS, NOW_DEFAULTS, ForeignKey
from seatledger.session import scratch_path
from seatledger.sources import catalogue, generators
from seatledger.sources.star_schema import LINE_ORDER, StarSchema
from seatledger.streaming import jobs
from seatledger.streaming import lifecycle as keyed

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Callable[[StarSchema], DataFrame]) -> Callable[[StarSchema], DataFrame]:
    """Register ``build`` under its name, with or without a leading underscore."""
    _QUERIES[build.__name__.lstrip("_")] = lambda spark, sf_dir: build(StarSchema(spark, sf_dir))
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


for _report in (
    reports.active_member_website_bookings,
    reports.avg_revenue_as_written,
    reports.avg_revenue_per_booking,
    reports.top_items_by_orders,
    reports.member_booking_summary,
    reports.high_penalty_bookings,
    reports.avg_duration_top10,
    reports.avg_total_by_item_active,
    reports.avg_total_by_item_active_dedup,
    reports.completion_ratio_top3,
    reports.top_servers_global,
    reports.top_server_per_restaurant,
    reports.busiest_slots,
):
    query(_report)


# --- generators and ingest ------------------------------------------------------------------


@query
def gen_time_slots(db):
    return generators.service_calendar(db.booking)


@query
def gen_availability_grid(db):
    return generators.availability_grid(db.rtable)


@query
def ingest_defaults(db):
    key = F.col("o_orderkey")
    arriving = db.raw("orders").select(
        key.alias("booking_id"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "P", "cancelled")
        .alias("booking_status"),
    )
    return changes.with_defaults(arriving, DEFAULTS["booking_status"])


def _arrivals(db) -> dict[str, tuple[DataFrame, str | None]]:
    """Rows as they arrive, without the columns that have defaults, and their event time."""
    asked = db.booking.withColumnRenamed("booking_created", "at")
    cancelled = db.bookings_in("cancelled").select("booking_id", F.col("booking_status"), F.col("booking_created").alias("at"))
    ordered = db.raw("lineitem").select(
        F.col("l_orderkey").alias("booking_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("int").alias("quantity"), F.col("l_shipdate").cast("timestamp").alias("at"),
    )
    told = db.command.select(F.col("command_id").alias("log_id"), F.col("command").alias("message"), F.col("ts").alias("at"))
    return {
        "member": (db.member.drop("cancellation_penalty"), None),
        "booking": (asked, "at"),
        "table_status": (generators.booked_days_grid(db.booking).select("table_id", "service_date", "slot_id"), None),
        "booking_status": (asked.select("booking_id", "at"), "at"),
        # Rows that bring the column keep what they bring, a NULL too.
        "booking_status, given": (cancelled.withColumn("last_activity", F.lit(None).cast("timestamp")), "at"),
        "order_line": (ordered, "at"),
        "billing": (billing.priced_lines(db.order_line, db.item).select("booking_id", "total_amount"), None),
        "program_log": (told, "at"),
    }


@query
def insert_defaults(db):
    """What inserts that leave out the columns with defaults store in them: rows per value, times by month."""
    found = []
    for arrival, (rows, event_time) in _arrivals(db).items():
        table = arrival.split(",")[0]
        stored_rows = catalogue.inserted(rows, table, event_time)
        for column in (*DEFAULTS.get(table, ()), *NOW_DEFAULTS.get(table, ())):
            value = F.date_format(column, "yyyy-MM") if column in NOW_DEFAULTS.get(table, ()) else F.col(column).cast("string")
            counted = stored_rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
            found.append(counted.select(F.lit(arrival).alias("arrival"), F.lit(column).alias("column_name"), "value", "n"))
    return audits.stack(found)


@query
def _dense_keys(db):
    lines = db.raw("lineitem").select(*LINE_ORDER)
    return dense_keys(lines, LINE_ORDER, "order_id").select("order_id", *LINE_ORDER)


# --- billing ----------------------------------------------------------------------------------


@query
def booking_price(db):
    return billing.booking_price(db.booking, db.order_line, db.item)


@query
def booking_totals(db):
    return billing.booking_totals(db.booking, db.order_line, db.item, db.restaurant)


@query
def billing_from_orders(db):
    return db.pending_billing


@query
def past_bookings(db):
    return billing.past_bookings(db.bookings_in("completed"), db.order_line, db.item, db.restaurant)


@query
def settle_bills(db):
    return db.billing


# --- availability and occupation -----------------------------------------------------------------


@query
def booking_slot_occupancy(db):
    return changes.booking_cells(db.open_state)


@query
def occupy_slots(db):
    return changes.occupy_slots(generators.booked_days_grid(db.booking, packed=True), db.open_state)


@query
def release_slots(db):
    occupied = changes.occupy_slots(generators.booked_days_grid(db.booking, packed=True), db.booking)
    return changes.release_slots(occupied, db.booking_status)


@query
def initial_booking_status(db):
    made = changes.initial_status(db.booking)
    return made.select(
        "booking_id", "booking_status", "employee_id",
        F.col("last_activity").cast("timestamp_ntz").alias("last_activity"),
    )


@query
def _available_tables(db):
    return available_tables(db.request, db.rtable, db.masks)



@query
def _find_available_table(db):
    found = find_available_table(db.request, db.rtable, db.masks)
    return found.select("request_id", "restaurant_id", "service_date", "table_id", "available_count")



@query
def _allocate_bookings(db):
    decided = allocate_bookings(db.request, db.rtable, db.masks, db.open_state)
    return decided.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def _allocate_bookings_per_date(db):
    decided = allocate_bookings(db.request, db.rtable, db.masks, db.open_state, gate=("member_id", "service_date"))
    return decided.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# --- staffing -----------------------------------------------------------------------------------


def _scheduled(db):
    return db.bookings_in("scheduled")


@query
def staff_load(db):
    return staffing.staff_load(db.shift, db.booking_status)


@query
def eligible_staff(db):
    return staffing.eligible_staff(db.booking, db.shift)


@query
def assign_staff_snapshot(db):
    return staffing.assign_staff_snapshot(_scheduled(db), db.shift, db.booking_status)


@query
def assign_staff_ordered(db):
    arriving = _scheduled(db).withColumnRenamed("booking_created", "ts")
    served = staffing.assign_staff_ordered(arriving, db.shift, db.booking_status)
    return served.drop("ts")


# --- lifecycle ----------------------------------------------------------------------------------


def _plain_ts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query
def members_with_open_booking(db):
    return lifecycle.members_with_open_booking(db.booking_state)


@query
def latest_open_booking(db):
    return lifecycle.latest_open_booking(db.booking_state)


@query
def member_checkins(db):
    return _plain_ts(lifecycle.member_checkins(db.commands_in("member_in"), db.booking_state), "ts")


@query
def member_checkouts(db):
    return _plain_ts(lifecycle.member_checkouts(db.commands_in("member_out"), db.booking_state), "ts")


@query
def validate_cancellations(db):
    return _plain_ts(lifecycle.validate_cancellations(db.commands_in("cancel_booking"), db.booking_state), "ts")


@query
def validate_orders(db):
    return _plain_ts(lifecycle.validate_orders(db.commands_in("order_food"), db.booking_state, db.menu), "ts")


@query
def cancellation_penalties(db):
    decided = lifecycle.validate_cancellations(db.commands_in("cancel_booking"), db.booking_state)
    return changes.cancellation_penalties(db.member, decided.where(F.col("outcome") == "cancelled"))


@query
def apply_status_changes(db):
    arrived = lifecycle.latest_open_booking(db.booking_state).where(F.col("booking_status") == "scheduled")
    bookings = db.booking.join(arrived.select("booking_id"), "booking_id", "left_semi")
    served = staffing.assign_staff_snapshot(bookings, db.shift, db.booking_status).select(
        "booking_id", F.lit("ongoing").alias("booking_status"), "employee_id"
    )
    return changes.apply_changes(db.booking_status, served, ["booking_id"], ["booking_status", "employee_id"])


def _outcomes(db):
    return lifecycle.command_outcomes(db.command, db.booking_state, db.menu, db.rtable, db.masks)


@query
def command_outcomes(db):
    return _plain_ts(_outcomes(db), "ts")


@query
def audit_log_messages(db):
    return _plain_ts(lifecycle.audit_log(_outcomes(db)), "log_timestamp")


@query
def lifecycle_replay(db):
    return _plain_ts(lifecycle.lifecycle_replay(db.command), "ts")


@query
def completed_transitions(db):
    return _plain_ts(lifecycle.completed_transitions(lifecycle.lifecycle_replay(db.command)), "completed_at")


@query
def last_activity(db):
    return _plain_ts(lifecycle.last_activity(lifecycle.lifecycle_replay(db.command)), "last_activity")


# --- cascade ------------------------------------------------------------------------------------


@query
def cascade_delete_restaurant(db):
    """Rows left per table after the restaurants of one location are deleted."""
    tables = {
        "restaurant": db.restaurant,
        "rtable": db.rtable,
        "booking": db.booking,
        "booking_status": db.booking_status,
        "order_line": db.numbered_order_line,
        "billing": db.pending_billing,
        "menu": db.menu,
        "shift": db.shift,
    }
    closed = db.restaurant.where(F.col("location") == "NATION_7").select("restaurant_id")
    left = changes.cascade_delete(tables, "restaurant", closed)
    return audits.stack(
        df.agg(F.count(F.lit(1)).alias("remaining")).select(F.lit(t).alias("table_name"), "remaining")
        for t, df in left.items()
    )


# --- audits -------------------------------------------------------------------------------------


def _table_status(db):
    return changes.occupy_slots(generators.booked_days_grid(db.booking, packed=True), db.open_state)


def _past_bookings(db):
    return billing.past_bookings(db.bookings_in("completed"), db.order_line, db.item, db.restaurant)


@query
def audit_primary_keys(db):
    line_key = F.concat_ws("/", "l_orderkey", "l_linenumber").alias("order_id")
    return audits.audit_primary_keys({
        "restaurant": db.restaurant, "rtable": db.rtable, "employee": db.employee, "member": db.member,
        "booking": db.booking, "item": db.item, "shift": db.shift,
        "order_line": db.raw("lineitem").select(line_key),
        "time_slot": db.time_slot, "billing": db.billing, "program_log": lifecycle.audit_log(_outcomes(db)),
    }, leave_out=["menu"])


@query
def audit_unique(db):
    tables = {"member": db.member, "item": db.item, "billing": db.billing}
    return audits.audit_unique(tables, leave_out=["member.phone_number"])


@query
def audit_foreign_keys(db):
    tables = {
        "restaurant": db.restaurant, "rtable": db.rtable, "employee": db.employee, "member": db.member,
        "time_slot": db.time_slot, "booking": db.booking, "booking_status": db.booking_status,
        "order_line": db.numbered_order_line, "item": db.item, "menu": db.menu, "shift": db.shift,
        "command": db.command, "billing": db.billing, "table_status": _table_status(db),
        "past_booking": _past_bookings(db),
    }
    commanded = (
        ForeignKey("command", "booking_id", "booking", "booking_id"),
        ForeignKey("command", "member_id", "member", "member_id"),
    )
    return audits.audit_foreign_keys(tables, (*FOREIGN_KEYS, *commanded))


@query
def audit_not_null(db):
    # Cancelled bookings as if their method had not been recorded, so that there is something to find.
    method = F.when(F.col("booking_status") != "cancelled", F.col("booking_method"))
    return audits.audit_not_null({
        "rtable": db.rtable, "employee": db.employee, "booking_status": db.booking_status,
        "booking": db.booking_state.withColumn("booking_method", method), "billing": db.plain_billing,
    }, leave_out=["member.login_method"])


@query
def audit_enum_domain(db):
    # The source's own market segments stand in for member statuses, so that there is something to find.
    segments = db.raw("customer").select(F.col("c_mktsegment").alias("member_status"))
    return audits.audit_enum_domain({
        "member": segments, "employee": db.employee, "booking": db.booking, "booking_status": db.booking_status,
        "billing": db.plain_billing, "table_status": _table_status(db),
    }, leave_out=["member.login_method"])


@query
def audit_type_bounds(db):
    # Supplier names stand in for zip codes, and unit prices as charged for those of the menu: both break rules.
    places = db.restaurant.withColumn("zip_code", F.col("restaurant_name"))
    charged = db.raw("lineitem").join(
        db.raw("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("item_name")), "l_partkey"
    )
    items = charged.select("item_name", (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return audits.audit_type_bounds({
        "restaurant": places, "employee": db.employee, "member": db.member, "item": items,
        "past_booking": billing.booking_totals(db.booking, db.order_line, db.item, db.restaurant),
        "billing": db.plain_billing, "program_log": lifecycle.audit_log(_outcomes(db)),
    }, leave_out=[
        "restaurant.phone_number", "restaurant.email", "employee.phone_number", "employee.email", "employee.username",
        "member.phone_number",
    ])


@query
def audit_status_one_to_one(db):
    # A status table that misses the cancelled bookings and repeats the completed ones.
    status = db.bookings_in("scheduled", "ongoing", "completed").select("booking_id")
    repeated = db.bookings_in("completed").select("booking_id")
    return audits.audit_status_one_to_one(db.booking, status.unionByName(repeated))


@query
def audit_double_booking(db):
    return audits.audit_double_booking(db.booking_state)


@query
def audit_slot_overrun(db):
    return audits.audit_slot_overrun(db.booking)


@query
def audit_member_single_open(db):
    return audits.audit_member_single_open(db.booking_state)


@query
def audit_billing_reconciliation(db):
    # Bills leave returned lines out and are paid for ongoing bookings too, so that both rules have findings.
    kept = db.lines_of(db.raw("lineitem").where(F.col("l_returnflag") != "R"))
    bills = billing.settle_bills(
        billing.priced_lines(kept, db.item).select(
            "booking_id", "total_amount", F.lit("pending").alias("payment_status")
        ),
        db.bookings_in("completed", "ongoing"),
    )
    return audits.audit_billing_reconciliation(
        db.booking_state, bills, billing.booking_price(db.booking, db.order_line, db.item)
    )


# --- streaming ----------------------------------------------------------------------------------


def _stream(db, table: str) -> DataFrame:
    return jobs.file_stream(db.spark, f"{db.root}/{table}.parquet")


@query
def stream_lifecycle(db):
    """Commands over several micro-batches, some of them delivered twice."""
    landed = jobs.deliver(
        db.command.select("command_id", "ts", "member_id", "command"), scratch_path(db.spark, "commands"), "ts", {}
    )
    decided = keyed.stream_lifecycle(landed)
    return _plain_ts(jobs.run_to_table(decided, scratch_path(db.spark, "stream-lifecycle")), "ts")


@query
def stream_billing(db):
    billed = jobs.stream_billing(db.lines_of(_stream(db, "lineitem")), db.item)
    return jobs.run_to_table(billed, scratch_path(db.spark, "stream-billing"))


def _settling(db) -> tuple[DataFrame, DataFrame]:
    """Check-outs, some delivered twice, and order lines, each once, as streams in event time.

    The source dates bookings by day: orders are placed half an hour after a booking's
    start, check-outs come in its last minutes, before midnight at the latest.
    """
    hour = F.make_dt_interval(hours=F.col("start_time_slot") + 9, mins=F.lit(30))
    closes = F.make_dt_interval(hours=F.least(F.col("start_time_slot") + F.col("booking_duration") + 8, F.lit(23)), mins=F.lit(59))
    state = db.booking_state
    ended = state.where(F.col("booking_status") == "completed").select(
        "booking_id", "restaurant_id", "booking_status", (F.col("booking_created") + closes).alias("completed_at")
    )
    ordered = db.order_line.join(state.select("booking_id", (F.col("booking_created") + hour).alias("order_time")), "booking_id")
    beat = {"booking_id": -1, "restaurant_id": -1, "item_id": -1, "booking_status": "completed"}
    return (
        jobs.deliver(ended, scratch_path(db.spark, "check-outs"), "completed_at", beat),
        jobs.deliver(ordered, scratch_path(db.spark, "orders"), "order_time", beat, again=0),
    )


@query
def stream_settlement(db):
    totals = jobs.stream_settlement(*_settling(db), db.item, db.restaurant)
    return jobs.run_to_table(totals, scratch_path(db.spark, "stream-settlement")).where(F.col("booking_id") >= 0)


@query
def stream_paid_bills(db):
    paid = jobs.stream_paid_bills(*_settling(db), db.item)
    return jobs.run_to_table(paid, scratch_path(db.spark, "stream-bills")).where(F.col("booking_id") >= 0)


@query
def stream_demand_tumbling(db):
    demand = jobs.demand_tumbling(db.commands_of(_stream(db, "events")))
    closed = jobs.run_to_table(demand, scratch_path(db.spark, "stream-demand"))
    return _plain_ts(closed, "window_start", "window_end")


@query
def stream_dedupe_commands(db):
    sent = db.commands_of(_stream(db, "events")).select("command_id", "ts", "command", "member_id")
    again = db.commands_of(_stream(db, "events")).select("command_id", "ts", "command", "member_id")
    once = jobs.dedupe_commands(sent.unionByName(again))
    return _plain_ts(jobs.run_to_table(once, scratch_path(db.spark, "stream-dedupe")), "ts")
