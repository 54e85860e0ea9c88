"""The column-wise state machine against one step at a time."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from seatledger.operators import lifecycle, replay


def step(code, command, state, booking):
    if code >= replay.CARRIED:
        return code - replay.CARRIED, command
    after = replay.NEXT_STATE[code][state]
    return after, command if code == replay.NEW and after != state else booking


segments = st.lists(st.tuples(st.integers(0, 4), st.lists(st.integers(0, 9), min_size=1, max_size=40)), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(segments)
def test_scan_equals_single_steps(parts):
    codes = np.array([c for _, own in parts for c in own])
    first = np.concatenate([np.arange(len(own)) == 0 for _, own in parts])
    entering = np.concatenate([np.full(len(own), s) for s, own in parts])
    ids, given_id = np.arange(len(codes)) + 2**60, np.arange(len(codes)) % 3 > 0
    starts = replay.segment_starts(first)
    nothing = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
    before, after, (booking, known) = replay.run(codes, (ids, given_id), starts, replay.prefix_maps(codes, starts), entering, nothing)
    at = 0
    for state, own in parts:
        held = None
        for code in own:
            was = state
            state, held = step(code, int(ids[at]) if given_id[at] else None, state, held)
            assert (before[at], after[at], int(booking[at]) if known[at] else None) == (was, state, held)
            at += 1


def test_members_go_on_over_arrow_batches():
    rng = random.Random(8)
    rows = sorted((rng.choice([-1, 1, 1, 2, 5]), i, rng.randrange(5)) for i in range(400))
    rows = [(None if m == -1 else m, i, c) for m, i, c in rows]
    columns = ["member_id", "command_id", "code", "enter_state", "enter_booking"]
    whole = [(m, i, c, 2 if m == 1 else None, 77 if m == 1 else None) for m, i, c in rows]
    want, state, held, last = [], None, None, object()
    for m, i, c, enter, booking in whole:
        if m is None or m != last:
            state, held, last = enter or 0, booking, m
        was = state
        state, held = step(c, i, state, held)
        want.append((was, state, held))
    for size in (1, 7, 400):
        batches = []
        for lo in range(0, len(whole), size):
            cut = list(zip(*whole[lo : lo + size]))
            batches.append(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cut], names=columns))
        got = [r for b in lifecycle._replay(iter(batches)) for r in zip(*(b.column(k).to_pylist() for k in ("before", "after", "booking_id")))]
        assert got == want


def test_effects_of_pieces_over_arrow_batches():
    rng = random.Random(9)
    rows = [(m, s, rng.randrange(10), 1000 + 10 * s + k) for m in (3, 4) for s in (1, 2) for k in range(rng.randrange(1, 30))]
    want = {}
    for m, s in {r[:2] for r in rows}:
        ends = []
        for enter in range(5):
            state, held = enter, None
            for _, _, code, command in (r for r in rows if r[:2] == (m, s)):
                state, held = step(code, command, state, held)
            ends.append((state, held))
        want[m, s] = [list(x) for x in zip(*ends)]
    for size in (1, 6, 500):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows[lo : lo + size])], names=["member_id", "segment_id", "code", "command_id"]
            )
            for lo in range(0, len(rows), size)
        ]
        got = {
            (r["member_id"], r["segment_id"]): [r["states"], r["bookings"]]
            for b in lifecycle._piece_effects(iter(batches)) for r in b.to_pylist()
        }
        assert got == want
