"""The booking lifecycle as a keyed stateful operator in event time.

Members share keyed state in groups. A member's commands wait in it until the watermark has passed them and are then
applied in (ts, command_id) order by the column-wise state machine of the batch replay. A
command may so arrive in any micro-batch within the watermark's delay, and more than once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from seatledger.functions.expressions import COMMANDS
from seatledger.operators.lifecycle import command_code, replay_outcome, state_name
from seatledger.operators.replay import NONE, prefix_maps, run, segment_starts
from seatledger.session import use_rocksdb

#: Groups of members that share a key of the state; a micro-batch costs a few state calls for each.
GROUPS = 2048
#: A waiting command as it lies in state: owner, whether it has no member, micros, id, code.
_WAITING = np.dtype([("owner", "<i8"), ("alone", "?"), ("ts", "<i8"), ("id", "<i8"), ("code", "<i2")])
#: Where a member stands: state and booking, if any.
_HELD = np.dtype([("owner", "<i8"), ("state", "<i2"), ("booking", "<i8"), ("booked", "?")])
_OUT = (
    "command_id bigint, micros bigint, member_id bigint, code int, before int, after int, booking_id bigint"
)


class MemberLifecycle(StatefulProcessor):
    """State of a group of members: the commands that wait, in one block for each micro-batch, and their bookings.

    Blocks are packed arrays, so a group costs a few state calls in a micro-batch however
    many members and commands it has. Commands of a group wait and are sorted in one task,
    as keyed state has it; the delay bounds how many wait.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "block binary")
        self.current = handle.getValueState("current", "held binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # Spark lets rows pass that only the watermark of this micro-batch makes late; timers have
        # run up to that watermark, so such a row would be applied out of order.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        parts = []
        for frame in rows:
            frame = frame[frame["code"].notna() & (frame["micros"] > passed)]
            if len(frame):
                part = np.empty(len(frame), _WAITING)
                part["owner"], part["alone"] = frame["owner"], frame["alone"]
                part["ts"], part["id"], part["code"] = frame["micros"], frame["command_id"], frame["code"]
                parts.append(part)
        if parts:
            block = np.concatenate(parts)
            self.waiting.appendValue((block.tobytes(),))
            self._wake_at(block["ts"].min())
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        blocks = [np.frombuffer(row[0], _WAITING) for row in self.waiting.get()]
        if not blocks:
            return
        waiting = np.concatenate(blocks)
        passed = waiting["ts"] <= timerValues.getCurrentWatermarkInMs() * 1000
        later, due = waiting[~passed], waiting[passed]
        if len(due) and len(later):
            self.waiting.put([(later.tobytes(),)])
        elif len(due):
            self.waiting.clear()
        if len(later):
            self._wake_at(later["ts"].min())
        if not len(due):
            return
        # The first copy of a command that an owner sent, then each owner's commands in order.
        due = due[np.lexsort((due["ts"], due["id"], due["owner"], due["alone"]))]
        due = due[_changes(due, "alone", "owner", "id")]
        yield self._apply(due[np.lexsort((due["id"], due["ts"], due["owner"], due["alone"]))])

    def _apply(self, due: np.ndarray) -> pd.DataFrame:
        held = np.frombuffer(self.current.get()[0], _HELD) if self.current.exists() else np.empty(0, _HELD)
        first = _changes(due, "alone", "owner")
        starts = segment_starts(first)
        known = np.zeros(len(due), bool)
        place = np.zeros(len(due), np.int64)
        if len(held):
            place = np.minimum(np.searchsorted(held["owner"], due["owner"]), len(held) - 1)
            known = (held["owner"][place] == due["owner"]) & ~due["alone"]
            state, booking, booked = held["state"][place], held["booking"][place], held["booked"][place]
        else:
            state = booking = booked = np.zeros(len(due), np.int64)
        codes = due["code"].astype(np.int64)
        before, after, (owner, owned) = run(
            codes, (due["id"], np.ones(len(due), bool)), starts, prefix_maps(codes, starts),
            np.where(known, state, NONE).astype(np.int64), (np.where(known, booking, 0), known & booked.astype(bool)),
        )
        last = np.append(first[1:], True) & ~due["alone"]
        if last.any():
            now = np.empty(int(last.sum()), _HELD)
            now["owner"], now["state"], now["booking"], now["booked"] = due["owner"][last], after[last], owner[last], owned[last]
            both = np.concatenate([held[~np.isin(held["owner"], now["owner"])], now])
            self.current.update((both[np.argsort(both["owner"])].tobytes(),))
        return pd.DataFrame({
            "command_id": due["id"], "micros": due["ts"], "member_id": pd.arrays.IntegerArray(due["owner"].copy(), due["alone"].copy()),
            "code": codes.astype(np.int32), "before": before.astype(np.int32), "after": after.astype(np.int32),
            "booking_id": pd.arrays.IntegerArray(owner.astype(np.int64), ~owned),
        })

    def _wake_at(self, micros: int) -> None:
        self.handle.registerTimer(-(-int(micros) // 1000))

    def close(self) -> None:
        pass


def _changes(rows: np.ndarray, *columns: str) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns; true for the first."""
    fresh = np.ones(len(rows), bool)
    fresh[1:] = False
    for c in columns:
        fresh[1:] |= rows[c][1:] != rows[c][:-1]
    return fresh


def stream_lifecycle(commands: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Decisions over a stream of (command_id, ts, member_id, command), in event time.

    A command is decided once the watermark, the latest ``ts`` seen less ``delay``, has
    passed it; so a stream that rests holds the commands of the last ``delay`` back until
    something later arrives. Rows whose ``command`` is unknown or null decide nothing and
    only move the watermark (a heartbeat). A command that arrives after the watermark has
    passed it is dropped, and so is a repeated one. Rows without command_id count as
    heartbeats, rows without ts are left out. A command without a member matches no booking
    and stands alone.

    Sets the session's state store to RocksDB, which keyed state with timers needs. Table
    scarcity is the batch allocator's concern.
    """
    use_rocksdb(commands.sparkSession)
    code = F.when(F.col("command_id").isNotNull(), command_code(F.col("command")))
    known = commands.where(F.col("ts").isNotNull()).select(
        "command_id", "ts", F.unix_micros("ts").alias("micros"), code.alias("code"),
        # Keys must not be null: Python would take two nulls for different keys.
        F.coalesce("member_id", "command_id", F.lit(0)).alias("owner"), F.col("member_id").isNull().alias("alone"),
    )
    grouped = known.withColumn("part", F.pmod(F.xxhash64("owner", "alone"), F.lit(GROUPS)))
    decided = grouped.withWatermark("ts", delay).groupBy("part").transformWithStateInPandas(
        MemberLifecycle(), outputStructType=_OUT, outputMode="append", timeMode="eventTime"
    )
    command = F.element_at(F.array(*(F.lit(c) for c in COMMANDS)), F.col("code") + 1)
    before = state_name(F.col("before"))
    return decided.select(
        "command_id", F.timestamp_micros("micros").alias("ts"), "member_id", command.alias("command"), "booking_id",
        before.alias("status_before"), state_name(F.col("after")).alias("status_after"),
        replay_outcome(command, before).alias("outcome"),
    )
