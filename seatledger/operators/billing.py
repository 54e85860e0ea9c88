"""Prices, taxes, bills and completed-booking totals in exact decimals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatledger.functions.expressions import from_cents, tax_amount, to_cents


def priced_lines(order_lines: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines with their amount; the price is the only column taken from the item."""
    return order_lines.join(items.select("item_id", "price"), "item_id").withColumn(
        "total_amount", (F.col("price") * F.col("quantity")).cast("decimal(18,2)")
    )


def line_sums(order_lines: DataFrame, items: DataFrame, keys: Sequence[str] = ("booking_id",)) -> DataFrame:
    """Summed amounts of the bookings that have order lines."""
    cents = items.select("item_id", to_cents(F.col("price")).alias("_cents"))
    return (
        order_lines.join(cents, "item_id")
        .groupBy(*keys)
        .agg(F.sum(F.col("_cents") * F.col("quantity")).alias("_sum"))
        .select(*keys, from_cents(F.col("_sum")).alias("price"))
    )


def with_prices(baskets: DataFrame, items: DataFrame, how: str = "inner") -> DataFrame:
    """Every row of ``baskets`` with the ``price`` of its whole booking (A12), by a window over the booking.

    Rows of one booking meet in one task, as its lines do in any case. With ``how="left"`` rows
    of unknown items stay; they add nothing to the price.
    """
    cents = items.select("item_id", to_cents(F.col("price")).alias("_cents"))
    total = F.sum(F.col("_cents") * F.col("quantity")).over(Window.partitionBy("booking_id"))
    return baskets.join(cents, "item_id", how).withColumn("price", from_cents(total)).drop("_cents")


def bill_sums(billing: DataFrame) -> DataFrame:
    """Price per booking from its bills, in the type of :func:`line_sums`."""
    return (
        billing.groupBy("booking_id")
        .agg(F.sum(to_cents(F.col("total_amount"))).alias("_sum"))
        .select("booking_id", from_cents(F.col("_sum")).alias("price"))
    )


def booking_price(bookings: DataFrame, order_lines: DataFrame, items: DataFrame) -> DataFrame:
    """Price per booking, NULL for a booking without orders."""
    return bookings.select("booking_id").join(line_sums(order_lines, items), "booking_id", "left")


def total_columns(taxed: DataFrame, *further: Column | str) -> DataFrame:
    """Tax rounded to cents, then price plus the rounded tax; NULL price stays NULL."""
    tax = tax_amount(F.col("price"), F.col("tax"))
    return taxed.select(
        "booking_id",
        F.col("price").alias("total_price"),
        tax.alias("total_tax"),
        (F.col("price") + tax).cast("decimal(18,2)").alias("total_price_after_tax"),
        *further,
    )


def with_totals(prices: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Totals of priced bookings with the tax of their restaurant."""
    return total_columns(prices.join(restaurants.select("restaurant_id", "tax"), "restaurant_id", "left"))


def booking_totals(
    bookings: DataFrame, order_lines: DataFrame, items: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """Price, tax and total of every booking from one pass over the order lines."""
    prices = bookings.select("booking_id", "restaurant_id").join(
        line_sums(order_lines, items), "booking_id", "left"
    )
    return with_totals(prices, restaurants)


def billing_from_orders(order_lines: DataFrame, items: DataFrame) -> DataFrame:
    """One pending bill per order line."""
    return priced_lines(order_lines, items).select(
        "order_id", "booking_id", "total_amount", F.lit("pending").alias("payment_status")
    )


def past_bookings(
    booking_state: DataFrame, order_lines: DataFrame, items: DataFrame, restaurants: DataFrame
) -> DataFrame:
    """Totals of completed bookings; one without orders yields NULL totals."""
    completed = booking_state.where(F.col("booking_status") == "completed")
    # Lines of other bookings never reach the item join.
    lines = order_lines.join(completed.select("booking_id"), "booking_id", "left_semi")
    return booking_totals(completed, lines, items, restaurants)


def settle_bills(billing: DataFrame, completed: DataFrame) -> DataFrame:
    """Bills of completed bookings become paid, all others keep their status."""
    paid = completed.select("booking_id").distinct().withColumn("_paid", F.lit(True))
    return billing.join(paid, "booking_id", "left").withColumn(
        "payment_status", F.when(F.col("_paid"), "paid").otherwise(F.col("payment_status"))
    ).drop("_paid")
