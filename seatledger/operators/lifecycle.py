"""Booking lifecycle: decide commands against a snapshot or replay them in order.

States: none -> scheduled -> ongoing -> completed, with scheduled -> cancelled.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatledger.functions.expressions import COMMANDS, SLOTS_PER_DAY, caller_message, log_message, slot_fits, slot_mask
from seatledger.operators.ordering import SEGMENT, ordered_segments, row_number_within
from seatledger.operators.replay import CARRIED, NONE, STATES, prefix_maps, run, segment_starts

OPEN = ("scheduled", "ongoing")

# --- decisions against a snapshot --------------------------------------------------------


def members_with_open_booking(booking_state: DataFrame) -> DataFrame:
    """R3 gate (O4, P5): members who hold a scheduled or ongoing booking, with the lowest id."""
    return (
        booking_state.where(F.col("booking_status").isin(*OPEN))
        .groupBy("member_id")
        .agg(F.min("booking_id").alias("existing_booking_id"))
    )


def latest_open_booking(booking_state: DataFrame) -> DataFrame:
    """Latest booking per member and open state; an aggregate, so hot members combine early."""
    return (
        booking_state.where(F.col("booking_status").isin(*OPEN))
        .groupBy("member_id", "booking_status")
        .agg(F.max("booking_id").alias("booking_id"))
    )


def _take_turns(commands: DataFrame, booking_state: DataFrame, state: str, done: str, refused: str) -> DataFrame:
    """Match a member's k-th command to its k-th latest booking in ``state``.

    Each command moves the latest remaining booking out of the state, so the k-th command
    of the batch gets the k-th latest one. That is the sequential result as one join.
    """
    turns = row_number_within(
        commands.select("command_id", "ts", "member_id"), ["member_id"], ["ts", "command_id"], "turn"
    )
    # Members outside the batch never reach the range shuffle.
    waiting = booking_state.where(F.col("booking_status") == state).join(
        commands.select("member_id").distinct(), "member_id", "left_semi"
    )
    queue = row_number_within(
        waiting.select("member_id", "booking_id", (-F.col("booking_id")).alias("_newest_first")),
        ["member_id"], ["_newest_first"], "turn",
    ).drop("_newest_first")
    return turns.join(queue, ["member_id", "turn"], "left").select(
        "command_id", "ts", "member_id", "booking_id",
        F.when(F.col("booking_id").isNotNull(), done).otherwise(refused).alias("outcome"),
    )


def member_checkins(commands: DataFrame, booking_state: DataFrame) -> DataFrame:
    """Each check-in takes the member's latest scheduled booking that is left."""
    mine = commands.where(F.col("command") == "member_in")
    return _take_turns(mine, booking_state, "scheduled", "checked_in", "no_scheduled_booking")


def member_checkouts(commands: DataFrame, booking_state: DataFrame) -> DataFrame:
    """Each check-out takes the member's latest ongoing booking that is left."""
    mine = commands.where(F.col("command") == "member_out")
    return _take_turns(mine, booking_state, "ongoing", "checked_out", "not_checked_in")


def validate_cancellations(commands: DataFrame, booking_state: DataFrame) -> DataFrame:
    """Decide a batch of cancellations in order; only the first one of a booking can succeed."""
    mine = commands.where(F.col("command") == "cancel_booking").select("command_id", "ts", "booking_id")
    state = booking_state.select(
        "booking_id", F.col("member_id").alias("owner_id"), F.col("booking_status").alias("current_status"),
        F.lit(True).alias("known"),
    )
    turn = F.struct("ts", "command_id")
    first = mine.groupBy("booking_id").agg(F.min(turn).alias("first_turn"))
    facts = first.join(state, "booking_id", "left")
    decided = (
        F.when(F.col("known").isNull(), "not_found")
        .when((F.col("current_status") == "scheduled") & (turn == F.col("first_turn")), "cancelled")
        .otherwise("not_allowed")
    )
    return mine.join(facts, "booking_id", "left").select(
        "command_id", "ts", "booking_id", F.col("owner_id").alias("member_id"), "current_status",
        decided.alias("outcome"),
    )


def validate_orders(commands: DataFrame, booking_state: DataFrame, menu: DataFrame) -> DataFrame:
    """R9 (P10-P12): an order needs an ongoing booking, then an available item on its menu."""
    mine = commands.where(F.col("command") == "order_food").select(
        "command_id", "ts", "booking_id", "item_id", "quantity"
    )
    state = booking_state.select("booking_id", "booking_status", "restaurant_id", "member_id")
    # Nothing declares a menu entry unique; an item is available if any of its entries says so.
    # Only entries that some order asks for are brought together.
    placed = mine.join(state, "booking_id", "left")
    asked = placed.select("restaurant_id", "item_id").distinct()
    offers = (
        menu.join(asked, ["restaurant_id", "item_id"], "left_semi")
        .groupBy("restaurant_id", "item_id")
        .agg(F.max("availability").alias("availability"))
    )
    return (
        placed.join(offers, ["restaurant_id", "item_id"], "left")
        .select(
            "command_id", "ts", "booking_id", "member_id", "restaurant_id", "item_id", "quantity",
            F.when(~(F.col("booking_status").eqNullSafe("ongoing")), "invalid_booking")
            .when(F.coalesce("availability", F.lit(False)), "accepted")
            .otherwise("item_unavailable")
            .alias("outcome"),
        )
    )


def _snapshot(booking_state: DataFrame, by_day: bool) -> DataFrame:
    """What commands ask of the bookings, by (tag, id, day), from one scan and one aggregate.

    ``b``: status, owner and restaurant of a booking. ``m``: a member's latest scheduled and
    ongoing booking and the first open one; ``g`` the same for one service date.
    """
    status, booking = F.col("booking_status"), F.col("booking_id")
    opened = status.isin(*OPEN)

    def fact(tag: str, key: Column, day: Column) -> Column:
        mine = F.lit(tag != "b")
        return F.struct(
            F.lit(tag).alias("tag"), key.cast("bigint").alias("id"), day.cast("date").alias("day"),
            F.when(mine & (status == "scheduled"), booking).alias("scheduled"),
            F.when(mine & (status == "ongoing"), booking).alias("ongoing"),
            F.when(mine, booking).alias("first_open"),
            F.when(~mine, F.struct(status.alias("status"), F.col("member_id").alias("owner"), F.col("restaurant_id").alias("place")))
            .alias("booked"),
        )

    member = [F.when(opened, fact("m", F.col("member_id"), F.lit(NO_DAY)))]
    if by_day:
        member.append(F.when(opened, fact("g", F.col("member_id"), F.col("service_date"))))
    facts = F.array_compact(F.array(fact("b", booking, F.lit(NO_DAY)), *member))
    return (
        booking_state.select(F.explode(facts).alias("f")).select("f.*").where("id is not null")
        .groupBy("tag", "id", "day")
        .agg(
            F.max("scheduled").alias("scheduled"), F.max("ongoing").alias("ongoing"), F.min("first_open").alias("first_open"),
            F.max("booked.status").alias("status"), F.max("booked.owner").alias("owner"), F.max("booked.place").alias("place"),
            F.max(F.col("tag") == "b").alias("exists"),
        )
    )


NO_DAY = "0001-01-01"


def _looked_up(rows: DataFrame, facts: DataFrame, keys: dict[str, Column], spread: str) -> DataFrame:
    """Left join of ``facts`` on the given keys; rows whose key is NULL don't meet in one task.

    Such a row takes a hash of its command in place of its key ``spread``, a long, and the
    join's condition keeps it from matching. (A constant in the keys would not do: the
    optimizer takes constants out of them.)
    """
    absent = reduce(lambda x, y: x | y, (k.isNull() for k in keys.values()))
    own = {f"_{n}": F.when(absent, F.xxhash64("command_id")).otherwise(k) if n == spread else k for n, k in keys.items()}
    keyed = rows.withColumns({**own, "_present": ~absent})
    named = facts.withColumnsRenamed({n: f"_its_{n}" for n in keys})
    meet = reduce(lambda x, y: x & y, (F.col(f"_{n}") == F.col(f"_its_{n}") for n in keys))
    joined = keyed.join(named, meet & F.col("_present"), "left")
    return joined.drop(*own, "_present", *(f"_its_{n}" for n in keys))


def command_outcomes(
    commands: DataFrame, booking_state: DataFrame, menu: DataFrame, rtables: DataFrame, masks: DataFrame,
    gate: Sequence[str] = ("member_id",), slots: int = SLOTS_PER_DAY,
) -> DataFrame:
    """The outcome of every command and the caller's message, each judged alone against the snapshot.

    An open booking of the member gates a request; ``gate`` may add ``service_date`` to ask
    for one of the same date. The effect of earlier commands in the batch is the business
    of :func:`lifecycle_replay` and ``allocate_bookings``.

    Commands are read once and looked up in four aggregates: bookings and members by tagged
    key, tables by restaurant, occupied slots by restaurant and date, the menu by
    restaurant and item. Bookings are read twice with the occupied slots. What a look-up
    found is boiled down before the next one, so that no list travels with the commands.
    """
    by_day = "service_date" in gate
    command, nothing = F.col("command"), F.lit(None).cast("bigint")
    new, ordered = command == "new_booking", command == "order_food"
    by_booking = command.isin("order_food", "cancel_booking")
    start, duration = F.col("start_time_slot"), F.col("booking_duration")
    known = commands.where(command.isin(*COMMANDS)).select(
        "command_id", "ts", "command", "member_id", "booking_id",
        F.when(new, F.col("restaurant_id")).alias("restaurant_id"), F.when(ordered, F.col("item_id")).alias("item_id"),
        F.when(new, F.col("service_date")).alias("service_date"),
        F.when(new & slot_fits(start, duration, slots), slot_mask(start, duration)).alias("wanted"),
    )
    gated = F.lit("g" if by_day else "m")
    day = F.when(new, F.col("service_date")).otherwise(F.lit(NO_DAY).cast("date")) if by_day else F.lit(NO_DAY).cast("date")
    facts = _looked_up(known, _snapshot(booking_state, by_day), {
        "tag": F.when(by_booking, F.lit("b")).when(new, gated).otherwise(F.lit("m")),
        "id": F.when(by_booking, F.col("booking_id")).otherwise(F.col("member_id")),
        "day": day,
    }, "id").select(
        "command_id", "ts", "command", "item_id", "service_date", "wanted",
        F.when(by_booking, F.col("owner")).otherwise(F.col("member_id")).alias("member_id"),
        F.when(new, F.col("restaurant_id")).when(ordered, F.col("place")).alias("restaurant_id"),
        F.when(by_booking, F.col("booking_id")).when(new, F.col("first_open")).when(command == "member_in", F.col("scheduled"))
        .otherwise(F.col("ongoing")).alias("booking_id"),
        F.when(by_booking, F.col("status")).alias("status"), F.when(by_booking, F.col("exists")).alias("exists"),
    )

    # New bookings: the lowest table of the restaurant that isn't taken in any slot asked for.
    taken = masks.join(rtables.select("table_id", "restaurant_id"), "table_id").groupBy("restaurant_id", "service_date").agg(
        F.collect_list(F.struct("table_id", "occupied_mask")).alias("taken")
    )
    asking = F.when(F.col("wanted").isNotNull(), F.col("restaurant_id"))
    placed = _looked_up(facts, taken, {"restaurant_id": asking, "service_date": F.col("service_date")}, "restaurant_id")
    overlaps = F.filter("taken", lambda t: t["occupied_mask"].bitwiseAND(F.col("wanted")) != 0)
    placed = placed.withColumn("blocked", F.transform(overlaps, lambda t: t["table_id"])).drop("taken", "service_date")
    tables = rtables.groupBy("restaurant_id").agg(F.collect_set("table_id").alias("tables"))
    placed = _looked_up(placed, tables, {"restaurant_id": asking}, "restaurant_id")
    free = F.array_except("tables", F.coalesce("blocked", F.array().cast("array<bigint>")))
    placed = placed.withColumn("seated", F.array_min(free).isNotNull()).drop("tables", "blocked", "wanted")

    # Orders: an ongoing booking, then an item that any entry of its restaurant's menu offers.
    offers = menu.groupBy("restaurant_id", "item_id").agg(F.max("availability").alias("offered"))
    serving = ordered & (F.col("status") == "ongoing")
    judged = _looked_up(placed, offers, {
        "restaurant_id": F.when(serving, F.col("restaurant_id")), "item_id": F.when(serving, F.col("item_id")),
    }, "restaurant_id")

    held = F.col("booking_id").isNotNull()
    outcome = (
        F.when(new, F.when(held, "has_open_booking").when(F.col("seated"), "confirmed").otherwise("no_table"))
        .when(command == "member_in", F.when(held, "checked_in").otherwise("no_scheduled_booking"))
        .when(command == "member_out", F.when(held, "checked_out").otherwise("not_checked_in"))
        .when(ordered, F.when(~F.coalesce(serving, F.lit(False)), "invalid_booking")
              .when(F.coalesce("offered", F.lit(False)), "accepted").otherwise("item_unavailable"))
        .otherwise(F.when(F.col("exists").isNull(), "not_found").when(F.col("status") == "scheduled", "cancelled").otherwise("not_allowed"))
    )
    decided = judged.withColumn("outcome", outcome)
    booking = F.when(F.col("outcome") == "confirmed", F.col("command_id")).otherwise(F.col("booking_id"))
    return decided.select(
        "command_id", "ts", "command", "member_id", booking.alias("booking_id"),
        F.when(new | ordered, F.col("restaurant_id")).otherwise(nothing).alias("restaurant_id"),
        F.when(ordered, F.col("item_id")).otherwise(nothing).alias("item_id"),
        "outcome", caller_message(F.col("outcome"), booking).alias("message"),
    )


def audit_log(outcomes: DataFrame) -> DataFrame:
    """Log rows for decided commands; an accepted order is not logged."""
    return outcomes.withColumn(
        "message",
        log_message(
            F.col("outcome"), F.col("member_id"), F.col("booking_id"), F.col("restaurant_id"), F.col("item_id")
        ),
    ).where(F.col("outcome") != "accepted").select(
        F.col("command_id").alias("log_id"), F.col("ts").alias("log_timestamp"), "message"
    )


# --- replay in order ---------------------------------------------------------------------

def replay_outcome(command: Column, before: Column) -> Column:
    """Outcome of a command in a state."""
    open_state = before.isin(*OPEN)
    return (
        F.when(command == "new_booking", F.when(open_state, "has_open_booking").otherwise("confirmed"))
        .when(command == "member_in", F.when(before == "scheduled", "checked_in").otherwise("no_scheduled_booking"))
        .when(command == "order_food", F.when(before == "ongoing", "accepted").otherwise("invalid_booking"))
        .when(command == "member_out", F.when(before == "ongoing", "checked_out").otherwise("not_checked_in"))
        .when(
            command == "cancel_booking",
            F.when(before == "none", "not_found").when(before == "scheduled", "cancelled").otherwise("not_allowed"),
        )
    )


def command_code(command: Column) -> Column:
    expr = None
    for i, name in enumerate(COMMANDS):
        expr = F.when(command == name, i) if expr is None else expr.when(command == name, i)
    return expr.cast("int")


def state_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATES]), code + 1)


_ENTERING = pa.schema([
    ("member_id", pa.int64()), (SEGMENT, pa.int32()), ("enter_state", pa.int32()), ("enter_booking", pa.int64()),
])
_EFFECT = "member_id bigint, segment_id int, states array<int>, bookings array<bigint>"


def _numbers(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """An integer column with zeros for NULLs, and where it has a value."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.int64())
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def _nullable(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=~known)


def _piece_effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each (member, segment) piece does to a member entering it in each possible state.

    A piece may go on over several batches: the states and bookings it has reached from
    each entry state are carried along.
    """
    every = np.arange(len(STATES))
    piece, states, bookings, known = None, every, np.zeros(len(every), np.int64), np.zeros(len(every), bool)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        members, segments, ends, ids = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(members, pa.int64()), pa.array(segments, pa.int32()),
                pa.array(ends, pa.list_(pa.int32())), pa.array(ids, pa.list_(pa.int64())),
            ],
            names=["member_id", "segment_id", "states", "bookings"],
        )

    def effect() -> tuple:
        return (*piece, states.tolist(), [int(b) if k else None for b, k in zip(bookings, known)])

    for batch in batches:
        if not batch.num_rows:
            continue
        (member, _), (segment, _), (code, _), command = (
            _numbers(batch, c) for c in ("member_id", SEGMENT, "code", "command_id")
        )
        first = np.ones(len(code), bool)
        first[1:] = (member[1:] != member[:-1]) | (segment[1:] != segment[:-1])
        starts = segment_starts(first)
        maps = prefix_maps(code, starts)
        nothing = np.zeros(len(code), np.int64), np.zeros(len(code), bool)
        reached = [run(code, command, starts, maps, np.full(len(code), s), nothing)[1:] for s in every]
        out = []
        for end in np.flatnonzero(np.append(first[1:], True)):
            here = int(member[end]), int(segment[end])
            if here != piece:
                if piece is not None:
                    out.append(effect())
                piece, states, bookings, known = here, every, np.zeros(len(every), np.int64), np.zeros(len(every), bool)
            # The piece's part in this batch, entered in the state that each entry has led to.
            own = [reached[s] for s in states]
            bookings = np.array([b[end] if k[end] else old for (_, (b, k)), old in zip(own, bookings)])
            known = np.array([k[end] or old for (_, (_, k)), old in zip(own, known)])
            states = np.array([after[end] for after, _ in own])
        if out:
            yield table(out)
    if piece is not None:
        yield table([effect()])


def _entering(pieces: pa.Table) -> pa.Table:
    """State in which one member enters each of its pieces; one row per piece."""
    state, booking, rows = NONE, None, []
    for piece in sorted(pieces.to_pylist(), key=lambda p: p[SEGMENT]):
        rows.append({
            "member_id": piece["member_id"], SEGMENT: piece[SEGMENT],
            "enter_state": state, "enter_booking": booking,
        })
        kept = piece["bookings"][state]
        booking = booking if kept is None else kept
        state = piece["states"][state]
    return pa.Table.from_pylist(rows, schema=_ENTERING)


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run the state machine over rows sorted by member and order.

    A command without a member matches no booking, so each one starts afresh. A member
    that goes on in the next batch takes its last state and booking along.
    """
    current, state, booking = None, NONE, (0, False)
    for batch in batches:
        if not batch.num_rows:
            continue
        (member, named), (code, _), command, (enter, _), (carried, holds) = (
            _numbers(batch, c) for c in ("member_id", "code", "command_id", "enter_state", "enter_booking")
        )
        first = ~named
        first[0] = True
        first[1:] |= member[1:] != member[:-1]
        first[1:] |= ~named[:-1]
        starts = segment_starts(first)
        entering, number, known = enter[starts], carried[starts], holds[starts]
        if named[0] and current == member[0]:
            goes_on = starts == 0
            entering[goes_on], number[goes_on], known[goes_on] = state, *booking
        before, after, (owner, owned) = run(code, command, starts, prefix_maps(code, starts), entering, (number, known))
        current = member[-1] if named[-1] else None
        state, booking = after[-1], (owner[-1], owned[-1])
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns, pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)),
                _nullable(owner, owned),
            ],
            names=[*batch.schema.names, "before", "after", "booking_id"],
        )


def lifecycle_replay(
    commands: DataFrame, carried: DataFrame | None = None, partitions: int | None = None
) -> DataFrame:
    """Replay each member's commands in (ts, command_id) order.

    Checks the member gate only; table scarcity and menus belong to the batch operators.
    ``carried`` (member_id, status, booking_id) continues from an earlier batch.

    Commands are range-partitioned by (member, order), so a member with very many
    commands is cut into pieces. A piece maps each of the five states it can be entered
    in to the state it ends in; chaining those maps gives every piece its entering state,
    after which all partitions replay independently.
    """
    steps = commands.where(F.col("command").isin(*COMMANDS)).select(
        "member_id", "ts", "command_id", "command", command_code(F.col("command")).alias("code")
    )
    if carried is not None:
        number = F.array_position(F.array(*[F.lit(s) for s in STATES]), F.col("status")) - 1
        steps = steps.unionByName(carried.select(
            "member_id",
            F.lit("0001-01-01 00:00:00").cast(steps.schema["ts"].dataType).alias("ts"),
            F.col("booking_id").alias("command_id"),
            F.lit(None).cast("string").alias("command"),
            (number + CARRIED).cast("int").alias("code"),
        ))
    ranged = ordered_segments(steps, ["member_id", "ts", "command_id"], partitions)

    # Only members crossing a partition border need an entering state: at most two pieces
    # per partition, which bounds both the broadcasts and the per-member group below.
    pieces = ranged.groupBy(SEGMENT).agg(F.min("member_id").alias("low"), F.max("member_id").alias("high"))
    border = (
        pieces.select(F.explode(F.array_distinct(F.array("low", "high"))).alias("member_id"))
        .groupBy("member_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("member_id")
    )
    effects = (
        ranged.join(F.broadcast(border), "member_id", "left_semi")
        .select("member_id", SEGMENT, "code", "command_id")
        .mapInArrow(_piece_effects, _EFFECT)
    )
    entering = effects.groupBy("member_id").applyInArrow(
        _entering, f"member_id bigint, {SEGMENT} int, enter_state int, enter_booking bigint"
    )
    replayed = (
        ranged.drop("position")
        .join(F.broadcast(entering), ["member_id", SEGMENT], "left")
        .select("member_id", "ts", "command_id", "command", "code", "enter_state", "enter_booking")
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in replayed.schema.fields)
    before = state_name(F.col("before"))
    return (
        replayed.mapInArrow(_replay, f"{schema}, before int, after int, booking_id bigint")
        .where(F.col("code") < CARRIED)
        .select(
            "command_id", "ts", "member_id", "command", "booking_id",
            before.alias("status_before"),
            state_name(F.col("after")).alias("status_after"),
            replay_outcome(F.col("command"), before).alias("outcome"),
        )
    )


def final_states(replayed: DataFrame) -> DataFrame:
    """Last state per member after a replay; feeds ``carried`` of the next batch."""
    last = F.max(F.struct("ts", "command_id", "status_after", "booking_id")).alias("last")
    return replayed.groupBy("member_id").agg(last).select(
        "member_id", F.col("last.status_after").alias("status"), F.col("last.booking_id").alias("booking_id")
    )


def completed_transitions(replayed: DataFrame) -> DataFrame:
    """The moments a booking went from ongoing to completed."""
    return replayed.where(
        (F.col("status_before") == "ongoing") & (F.col("status_after") == "completed")
    ).select("booking_id", "member_id", F.col("ts").alias("completed_at"))


def last_activity(replayed: DataFrame) -> DataFrame:
    """Latest status change per booking."""
    return (
        replayed.where(F.col("status_before") != F.col("status_after"))
        .groupBy("booking_id")
        .agg(F.max("ts").alias("last_activity"))
    )
