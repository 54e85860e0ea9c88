"""The booking state machine over columns: composed transition maps instead of a step per command.

A command maps each of the five states to the state it leads to. Composing maps is
associative, so the map of all commands up to a row comes from a segmented prefix scan:
in round k every row takes on the map of the row ``2**k`` before it in its own segment.
Rounds are the logarithm of the longest segment, each a few whole-column operations.
"""

from __future__ import annotations

import numpy as np

STATES = ("none", "scheduled", "ongoing", "completed", "cancelled")
NONE, SCHEDULED, ONGOING, COMPLETED, CANCELLED = range(5)
NEW, IN, ORDER, OUT, CANCEL = range(5)

# NEXT_STATE[command][state]: the state machine, commands and states by position above.
NEXT_STATE = (
    (SCHEDULED, SCHEDULED, ONGOING, SCHEDULED, SCHEDULED),
    (NONE, ONGOING, ONGOING, COMPLETED, CANCELLED),
    (NONE, SCHEDULED, ONGOING, COMPLETED, CANCELLED),
    (NONE, SCHEDULED, COMPLETED, COMPLETED, CANCELLED),
    (NONE, CANCELLED, ONGOING, COMPLETED, CANCELLED),
)
# Codes from here on are carried-over states, not commands: code - CARRIED is the state.
CARRIED = len(NEXT_STATE)


def _closure() -> tuple[np.ndarray, np.ndarray]:
    """All maps that commands can compose to, the ten single ones first, and their products.

    There are few: every command sequence acts as one of them, so a map is a small number
    and composing two is one look-up.
    """
    maps = [*NEXT_STATE, *((state,) * len(STATES) for state in range(len(STATES)))]
    known = {m: k for k, m in reversed([*enumerate(maps)])}
    for m in maps:
        for generator in NEXT_STATE:
            longer = tuple(generator[s] for s in m)
            if longer not in known:
                known[longer] = len(maps)
                maps.append(longer)
    product = [[known[tuple(then[s] for s in m)] for then in maps] for m in maps]
    return np.array(maps, np.int8), np.array(product, np.int16)


MAPS, THEN = _closure()

#: Booking ids as numbers beside a mask of where there is one.
Bookings = tuple[np.ndarray, np.ndarray]


def segment_starts(first: np.ndarray) -> np.ndarray:
    """Row at which the segment of each row begins; ``first`` marks the first rows."""
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))


def prefix_maps(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the map of all commands of a row's segment up to and including the row."""
    maps = codes.astype(np.int16)
    behind = np.arange(len(codes)) - starts
    step, rows = 1, np.flatnonzero(behind >= 1)
    while len(rows):
        maps[rows] = THEN[maps[rows - step], maps[rows]]
        step *= 2
        rows = rows[behind[rows] >= step]
    return maps


def run(
    codes: np.ndarray, ids: Bookings, starts: np.ndarray, maps: np.ndarray, entering: np.ndarray, entering_booking: Bookings
) -> tuple[np.ndarray, np.ndarray, Bookings]:
    """State before and after every row, and its booking.

    ``entering`` and ``entering_booking`` hold, on every row, what its segment begins
    with. A confirmed booking takes the id of its command and stays until the next one; a
    carried-over state brings its booking, or none, as its id.
    """
    rows = np.arange(len(codes))
    after = MAPS[maps, entering]
    before = np.where(rows == starts, entering, np.roll(after, 1)).astype(np.int8)
    confirmed = ((codes == NEW) & (after != before)) | (codes >= CARRIED)
    latest = np.maximum.accumulate(np.where(confirmed, rows, -1))
    own = latest >= starts
    number, known = entering_booking
    return before, after, (np.where(own, ids[0][latest], number), np.where(own, ids[1][latest], known))
