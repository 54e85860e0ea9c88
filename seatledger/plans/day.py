"""Command batches applied to a database: the booking procedures with all their effects.

Each function takes the database and a batch of commands and returns the database after
the batch together with the decisions. Nothing is written: tables stay lazy DataFrames,
so save them (or :func:`settle_to`) between batches to keep the lineage short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatledger.operators import billing, changes, lifecycle, staffing
from seatledger.operators.audits import ColumnWatch
from seatledger.operators.allocate import allocate_bookings
from seatledger.operators.availability import grid_masks
from seatledger.sources.tables import Database, reload_table


def _like(df: DataFrame, table: DataFrame) -> DataFrame:
    """``df`` with the columns of ``table``; columns it lacks become NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields
    ])


def _append(table: DataFrame, rows: DataFrame) -> DataFrame:
    return table.unionByName(_like(rows, table))


def _logged(db: Database, decided: DataFrame) -> DataFrame:
    missing = [c for c in ("booking_id", "restaurant_id", "item_id", "member_id") if c not in decided.columns]
    full = decided.withColumns({c: F.lit(None).cast("bigint") for c in missing})
    return _append(db.program_log, lifecycle.audit_log(full))


def book(db: Database, commands: DataFrame) -> tuple[Database, DataFrame]:
    """Allocate requests in order, then occupy cells and open status rows.

    A confirmed booking takes its command's id.
    """
    wanted = commands.where(F.col("command") == "new_booking").withColumnRenamed("command_id", "request_id")
    open_state = db.booking_state.where(F.col("booking_status").isin("scheduled", "ongoing"))
    decided = allocate_bookings(
        wanted.select(
            "request_id", "ts", "member_id", "restaurant_id", "service_date", "start_time_slot", "booking_duration"
        ),
        db.rtable, grid_masks(db.table_status), open_state,
    ).checkpoint()
    accepted = (
        decided.where(F.col("outcome") == "confirmed")
        .join(wanted.select("request_id", "booking_method"), "request_id")
        .withColumn("booking_id", F.col("request_id"))
        .withColumn("booking_created", F.col("ts"))
    )
    outcome = decided.select(
        F.col("request_id").alias("command_id"), "ts", "member_id", "restaurant_id", "outcome", "table_id",
        F.when(F.col("outcome") == "confirmed", F.col("request_id")).otherwise(F.col("existing_booking_id"))
        .alias("booking_id"),
    )
    return db.replace(
        booking=_append(db.booking, accepted),
        booking_status=_append(db.booking_status, changes.initial_status(accepted)),
        table_status=changes.occupy_slots(db.table_status, accepted),
        program_log=_logged(db, outcome),
    ), outcome


def check_in(db: Database, commands: DataFrame) -> tuple[Database, DataFrame]:
    """Latest scheduled booking becomes ongoing and gets the least-loaded employee, in order."""
    outcome = lifecycle.member_checkins(commands, db.booking_state).checkpoint()
    done = outcome.where(F.col("outcome") == "checked_in").select("booking_id", "ts")
    places = db.booking.select("booking_id", "restaurant_id", "start_time_slot").join(done, "booking_id")
    served = staffing.assign_staff_ordered(places, db.shift, db.booking_status)
    update = served.select(
        "booking_id", F.lit("ongoing").alias("booking_status"), "employee_id", F.col("ts").alias("last_activity")
    )
    status = changes.apply_changes(
        db.booking_status, update, ["booking_id"], ["booking_status", "employee_id", "last_activity"]
    )
    return db.replace(booking_status=status, program_log=_logged(db, outcome)), outcome


def order_food(db: Database, commands: DataFrame) -> tuple[Database, DataFrame]:
    """Accepted orders become order lines with one pending bill each."""
    outcome = lifecycle.validate_orders(commands, db.booking_state, db.menu).checkpoint()
    lines = outcome.where(F.col("outcome") == "accepted").select(
        F.col("command_id").alias("order_id"), "booking_id", "item_id", "quantity", F.col("ts").alias("order_time")
    )
    return db.replace(
        order_line=_append(db.order_line, lines),
        billing=_append(db.billing, billing.billing_from_orders(lines, db.item)),
        program_log=_logged(db, outcome),
    ), outcome


def check_out(db: Database, commands: DataFrame) -> tuple[Database, DataFrame]:
    """Latest ongoing booking is completed, totalled, paid, and its cells are vacated."""
    outcome = lifecycle.member_checkouts(commands, db.booking_state).checkpoint()
    done = outcome.where(F.col("outcome") == "checked_out")
    update = done.select(
        "booking_id", F.lit("completed").alias("booking_status"), F.col("ts").alias("last_activity")
    )
    status = changes.apply_changes(db.booking_status, update, ["booking_id"], ["booking_status", "last_activity"])
    completed = db.booking.join(update, "booking_id").select("booking_id", "restaurant_id", "booking_status")
    totals = billing.past_bookings(completed, db.order_line, db.item, db.restaurant)
    return db.replace(
        booking_status=status,
        past_booking=_append(db.past_booking, totals),
        billing=billing.settle_bills(db.billing, completed),
        table_status=changes.release_slots(db.table_status, update),
        program_log=_logged(db, outcome),
    ), outcome


def cancel(db: Database, commands: DataFrame) -> tuple[Database, DataFrame]:
    """Scheduled bookings are cancelled, their cells released and the member charged."""
    outcome = lifecycle.validate_cancellations(commands, db.booking_state).checkpoint()
    done = outcome.where(F.col("outcome") == "cancelled")
    update = done.select(
        "booking_id", F.lit("cancelled").alias("booking_status"),
        F.col("ts").alias("cancelled_on"), F.col("ts").alias("last_activity"),
    )
    status = changes.apply_changes(
        db.booking_status, update, ["booking_id"], ["booking_status", "cancelled_on", "last_activity"]
    )
    charged = changes.cancellation_penalties(db.member, done).select(
        "member_id", F.col("penalty_after").alias("cancellation_penalty")
    )
    return db.replace(
        booking_status=status,
        member=_like(changes.apply_changes(db.member, charged, ["member_id"], ["cancellation_penalty"]), db.member),
        table_status=changes.release_slots(db.table_status, update),
        program_log=_logged(db, outcome),
    ), outcome


def settle_to(db: Database, root: str, watch: ColumnWatch | None = None) -> Database:
    """Write every table to a fresh folder and continue from the files, cutting the lineage.

    ``watch`` counts broken column rules on the way, without a scan of its own.
    """
    stored = {}
    for name, df in db.tables().items():
        path = f"{root.rstrip('/')}/{name}"
        reload_table(watch.over(df, name) if watch else df, path)
        stored[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return Database(stored)
