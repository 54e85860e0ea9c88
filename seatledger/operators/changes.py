"""Updates, cascades and defaults as state x changes -> new state.

Files are immutable, so every change operator returns the new table; the caller
writes it to a new version or overwrites the touched partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatledger.functions.expressions import CANCELLATION_FEE, SLOTS_PER_DAY, slots_of
from seatledger.schemas import FOREIGN_KEYS, ForeignKey
from seatledger.session import scratch_path


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with declared column defaults, keeping each column's type."""
    types = dict(df.dtypes)
    filled = {
        name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
        for name, value in defaults.items()
        if name in types
    }
    return df.withColumns(filled) if filled else df


def latest_change(changes: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last change per key. A partial aggregate, so a hot key is reduced before the shuffle."""
    rest = [c for c in changes.columns if c not in key]
    ranked = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    return (
        changes.groupBy(*key).agg(F.max(ranked).alias("_last")).select(*key, *[f"_last.{c}" for c in rest])
    )


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    insert: bool = False,
) -> DataFrame:
    """Overwrite ``columns`` of ``base`` where ``changes`` has the key.

    ``changes`` holds at most one row per key (see :func:`latest_change`). A flag decides
    whether a row changed, so a change may write NULL. With ``insert`` unmatched changes
    become new rows whose other columns are NULL.
    """
    key = list(key)
    update = changes.select(
        *key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_set")
    )
    joined = base.join(update, key, "full" if insert else "left")
    return joined.select(
        *[
            F.when(F.col("_set"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in base.columns
        ]
    )


def booking_cells(bookings: DataFrame) -> DataFrame:
    """One row per (booking, slot) it occupies, turning the interval into an equi-key.

    The factor is the booking duration. A booking that runs past closing holds its table for
    the slots beyond the day's last one as well, though a grid has no cells for them.
    """
    return bookings.select(
        "booking_id", "table_id", "service_date",
        F.explode(slots_of(F.col("start_time_slot"), F.col("booking_duration"))).alias("slot_id"),
    )


def occupy_slots(grid: DataFrame, accepted: DataFrame) -> DataFrame:
    """Mark the cells of accepted bookings occupied; the latest booking wins a shared cell.

    Bookings are brought together by table and date, one row with the winner of each slot,
    combined before the shuffle. The grid meets these rows by table and date. A ``packed``
    grid (see :func:`booked_days_grid`) does so day by day and is unpacked afterwards, so its
    cells are neither shuffled nor sorted.
    """
    start, duration = F.col("start_time_slot"), F.col("booking_duration")
    slots = range(1, SLOTS_PER_DAY + 1)
    covers = [(duration >= 1) & (start <= k) & (start + duration > k) for k in slots]
    held = reduce(lambda x, y: x + y, (F.when(c, 1 << k).otherwise(0) for k, c in zip(slots, covers)))
    days = (
        accepted.groupBy(F.col("table_id").alias("_table"), F.col("service_date").alias("_date"))
        .agg(
            F.bit_or(held).alias("_held"),
            *(F.max(F.when(c, F.col("booking_id"))).alias(f"_slot{k}") for k, c in zip(slots, covers)),
        )
        .select("_table", "_date", "_held", F.array(*(f"_slot{k}" for k in slots)).alias("_winners"))
    )
    joined = grid.join(days, (F.col("table_id") == F.col("_table")) & (F.col("service_date") == F.col("_date")), "left")
    if "vacant_slots" in grid.columns:
        joined = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("vacant_slots"))).alias("slot_id")).select(
            "*", F.lit(None).cast("bigint").alias("booking_id"), F.lit("vacant").alias("status")
        ).drop("vacant_slots")
    taken = F.col("slot_id").between(1, SLOTS_PER_DAY) & F.getbit(F.col("_held"), _within_day("slot_id")).eqNullSafe(1)
    new = {"booking_id": F.element_at("_winners", _within_day("slot_id")), "status": F.lit("occupied")}
    return joined.select(*(
        F.when(taken, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
        for c in joined.columns if c not in days.columns
    ))


def _within_day(slot: str) -> Column:
    """A slot number that is safe as a position, whatever the column holds."""
    return F.greatest(F.lit(1), F.least(F.col(slot), F.lit(SLOTS_PER_DAY))).cast("int")


def release_slots(grid: DataFrame, booking_status: DataFrame) -> DataFrame:
    """D3: vacate the cells of finished bookings.

    A cancellation clears the cell's booking, a check-out leaves the stale id behind, so
    occupation has to be read from the status. Only cells that name a booking meet the
    statuses; the others, most of a grid, stay where they are.
    """
    finished = booking_status.where(F.col("booking_status").isin("cancelled", "completed")).select(
        F.col("booking_id").alias("_match"), F.col("booking_status").alias("_final")
    )
    named = grid.where(F.col("booking_id").isNotNull())
    joined = named.join(finished, F.col("booking_id") == F.col("_match"), "left")
    settled = joined.select(
        "table_id", "service_date", "slot_id",
        F.when(F.col("_final") == "cancelled", F.lit(None)).otherwise(F.col("booking_id")).cast("bigint")
        .alias("booking_id"),
        F.when(F.col("_final").isNotNull(), F.lit("vacant")).otherwise(F.col("status")).alias("status"),
    )
    unnamed = grid.where(F.col("booking_id").isNull())
    return settled.unionByName(unnamed.select(
        "table_id", "service_date", "slot_id", F.lit(None).cast("bigint").alias("booking_id"), "status"
    ))


def initial_status(accepted: DataFrame, at: str = "booking_created") -> DataFrame:
    """The status row that accompanies every accepted booking."""
    return accepted.select(
        "booking_id",
        F.lit("scheduled").alias("booking_status"),
        F.lit(None).cast("bigint").alias("employee_id"),
        F.lit(None).cast("timestamp").alias("cancelled_on"),
        F.col(at).alias("last_activity"),
    )


def cancellation_penalties(members: DataFrame, cancelled: DataFrame) -> DataFrame:
    """Add the fee for each cancelled booking; several per member in one batch add up."""
    fees = cancelled.groupBy("member_id").agg(F.count(F.lit(1)).alias("cancellations"))
    count = F.coalesce(F.col("cancellations"), F.lit(0)).cast("bigint")
    return members.join(fees, "member_id", "left").select(
        "member_id",
        F.col("cancellation_penalty").alias("penalty_before"),
        count.alias("cancellations"),
        (F.col("cancellation_penalty") + count * F.lit(CANCELLATION_FEE)).cast("decimal(18,2)")
        .alias("penalty_after"),
    )


def touch(status: DataFrame, activity: DataFrame, ts: str = "ts") -> DataFrame:
    """Raise ``last_activity`` to the latest event time seen per booking."""
    latest = activity.groupBy("booking_id").agg(F.max(ts).alias("_seen"))
    return status.join(latest, "booking_id", "left").withColumn(
        "last_activity", F.greatest("last_activity", "_seen")
    ).drop("_seen")


def cascade_delete(
    tables: Mapping[str, DataFrame],
    root: str,
    deleted: DataFrame,
    foreign_keys: Iterable[ForeignKey] = FOREIGN_KEYS,
) -> dict[str, DataFrame]:
    """Remove rows of ``root`` and everything that references them, level by level.

    ``deleted`` carries the root's key column. Every table is read once: it meets the keys
    its parents lost in one pass that marks each row, NULL references staying unmarked. A
    table with children of its own is written with its marks, so that the rows that stay
    and the keys it lost are two folders of the same write. Runs when called.
    """
    spark = deleted.sparkSession
    edges = [fk for fk in foreign_keys if fk.child in tables and fk.parent in tables]
    lost: dict[str, DataFrame] = {root: deleted}
    remaining = dict(tables)
    for name in _children_after_parents(edges, root):
        if name == root:
            remaining[name] = tables[name].join(deleted, deleted.columns, "left_anti")
            continue
        marked = _marked(tables[name], [fk for fk in edges if fk.child == name and fk.parent in lost], lost)
        referenced = sorted({fk.parent_key for fk in edges if fk.parent == name})
        if referenced:
            folder = scratch_path(spark, f"cascade-{name}")
            marked.write.partitionBy("_gone").parquet(folder)
            marked = spark.read.schema(marked.schema).parquet(folder)
            lost[name] = marked.where("_gone").select(*referenced).distinct()
        remaining[name] = marked.where("not _gone").drop("_gone")
    return remaining


def _marked(frame: DataFrame, references: list[ForeignKey], lost: Mapping[str, DataFrame]) -> DataFrame:
    """``frame`` with ``_gone``: whether any of its references is among the lost keys."""
    columns, hits = frame.columns, []
    for i, fk in enumerate(references):
        hits.append(F.coalesce(F.col(f"_hit{i}"), F.lit(False)))
        keys = lost[fk.parent].select(F.col(fk.parent_key).alias(f"_key{i}"), F.lit(True).alias(f"_hit{i}")).distinct()
        frame = frame.join(keys, F.col(fk.column) == F.col(f"_key{i}"), "left")
    gone = F.lit(False)
    for hit in hits:
        gone = gone | hit
    return frame.select(*columns, gone.alias("_gone"))


def _children_after_parents(edges: list[ForeignKey], root: str) -> list[str]:
    """Tables reachable from ``root``, every table after all of its reachable parents."""
    reachable = {root}
    grew = True
    while grew:
        new = {fk.child for fk in edges if fk.parent in reachable} - reachable
        reachable |= new
        grew = bool(new)
    done: list[str] = []
    while len(done) < len(reachable):
        for name in sorted(reachable - set(done)):
            parents = {fk.parent for fk in edges if fk.child == name} & reachable
            if name == root or parents <= set(done):
                done.append(name)
                break
        else:
            raise ValueError("foreign keys form a cycle")
    return done
