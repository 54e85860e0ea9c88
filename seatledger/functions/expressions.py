"""Pure column expressions: slot arithmetic, money and log messages."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SLOTS_PER_DAY = 14  # hourly starts 10:00 .. 23:00
FIRST_HOUR = 10
MAX_MASK_SLOTS = 63  # slots a signed 64-bit occupancy mask can hold

CANCELLATION_FEE = Decimal("2.00")


def slot_start_time(slot: Column, first_hour: int = FIRST_HOUR, step_minutes: int = 60) -> Column:
    """'HH:mm:ss' start of a 1-based slot."""
    minutes = (F.lit(first_hour * 60) + (slot - 1) * step_minutes).cast("int")
    return F.format_string("%02d:%02d:00", F.floor(minutes / 60), minutes % 60)


def int_div(value: Column, divisor: int) -> Column:
    """Integer quotient without a detour over doubles."""
    return F.call_function("div", value, F.lit(divisor))


def slot_fits(start: Column, duration: Column, slots: int = SLOTS_PER_DAY) -> Column:
    """True when [start, start + duration) is a non-empty interval inside the day; never NULL."""
    inside = (start >= 1) & (duration >= 1) & (start + duration - 1 <= slots)
    return F.coalesce(inside, F.lit(False))


def slot_mask(start: Column, duration: Column) -> Column:
    """Bit k-1 set for every slot k of a fitting interval."""
    one = F.lit(1).cast("bigint")
    run = F.call_function("shiftleft", one, duration.cast("int")) - one
    return F.call_function("shiftleft", run, (start - 1).cast("int"))


def slots_of(start: Column, duration: Column) -> Column:
    """The slots an interval covers, as an array; empty for a duration below one."""
    last = start + duration - 1
    return F.when(duration >= 1, F.sequence(start, last)).otherwise(F.array().cast("array<int>"))


def tax_amount(price: Column, tax_percent: Column) -> Column:
    """Tax on a price, rounded half up to cents; NULL price gives NULL tax."""
    return (price * tax_percent * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def to_cents(amount: Column) -> Column:
    """A two-digit amount as whole cents. Sums of longs stay exact and, unlike sums of wide
    decimals, need no object per row; an overflow raises."""
    return (amount * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    return (cents.cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def exact_mean(total: Column, count: Column) -> Column:
    """Mean from an exact sum and a count; NULL when nothing was counted."""
    return F.when(count > 0, total.cast("double") / count)


# --- lifecycle decisions ----------------------------------------------------------------

COMMANDS = ("new_booking", "member_in", "order_food", "member_out", "cancel_booking")


def log_message(
    outcome: Column, member: Column, booking: Column, restaurant: Column, item: Column
) -> Column:
    """Audit-log text for a decided command; NULL where nothing is logged.

    Fixed values: the wording of the messages.
    """

    def line(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    return (
        F.when(
            outcome == "has_open_booking",
            line("Member ID: ", member, " with existing booking with id ", booking, " tried new booking. FAILED!!"),
        )
        .when(outcome == "confirmed", line("Booking with ID ", booking, " created for member ID", member, ". SUCCESS!!"))
        .when(outcome == "no_table", line("No table found for Member ID", member, ". FAILED!!"))
        .when(
            outcome == "checked_in",
            line("Member ID ", member, " with booking ID ", booking, " has checked in. SUCCESS!!"),
        )
        .when(
            outcome == "no_scheduled_booking",
            line("Member ID ", member, " with no booking tried checking in. FAILED!!"),
        )
        .when(
            outcome == "checked_out",
            line("Member ID ", member, " with booking ID ", booking, " has checked out. SUCCESS!!"),
        )
        .when(
            outcome == "not_checked_in",
            line("Member ID ", member, " with no valid booking tried checking out. FAILED!!"),
        )
        .when(outcome == "cancelled", line("Booking ID ", booking, " by member ID ", member, " is CANCELLED!!"))
        .when(
            outcome == "not_allowed",
            line("Booking ID ", booking, " by member ID ", member, " tried cancelling. FAILED!!"),
        )
        .when(
            outcome == "not_found",
            line("Booking ID ", booking, " does not eexist and cannot be cancelled. FAILED!!"),
        )
        .when(
            outcome == "item_unavailable",
            line(
                "MenuItem ID ", item, " at restaurant ID ", restaurant,
                " was not available for booking ID ", booking, ". FAILED!!",
            ),
        )
        .when(
            outcome == "invalid_booking",
            line("Booking ID ", booking, " which is not a valid tried ordering food. FAILED!!"),
        )
    )


def caller_message(outcome: Column, booking: Column) -> Column:
    """What the caller of a command is told; NULL after a check-out, which tells nothing.

    Fixed values: the wording of the messages.
    """
    held = F.concat(
        F.lit("Member already has a scheduled booking. Please handle existing booking (ID:"), booking,
        F.lit(") before creating a new one."),
    )
    texts = {
        "confirmed": "Booking Confirmed",
        "no_table": "No available table found for the requested time slot.",
        "cancelled": "Order cancelled successfully.",
        "not_allowed": "Order cancellation not allowed.",
        "not_found": "Order does not exist.",
        "checked_in": "has checked-in.",
        "no_scheduled_booking": "No scheduled booking found for member ID",
        "not_checked_in": " has not checked in.",
        "accepted": "Order recieved",
        "item_unavailable": "MenuItem is unavailable",
        "invalid_booking": "Not a valid Booking ID",
    }
    message = F.when(outcome == "has_open_booking", held)
    for code, text in texts.items():
        message = message.when(outcome == code, F.lit(text))
    return message
