"""Incremental maintenance of the derived booking tables.

Every job reads a file stream, is started with ``availableNow`` and keeps its checkpoint
in the shared folder, so it can be restarted after a loss and picks up where it was.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger.functions.expressions import from_cents, to_cents
from seatledger.operators import billing as bills
from seatledger.session import use_rocksdb

def file_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of files, as a stream with the schema it carries."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A stream refuses the plain path of a file but takes a pattern that matches only it.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Process what is available into an exactly-once parquet table and return it."""
    query = (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", f"{path}.checkpoint").trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def deliver(
    df: DataFrame, path: str, time_column: str, heartbeat: dict[str, object], parts: int = 2, files: int = 4,
    again: float = 0.25, quiet: timedelta = timedelta(days=2),
) -> DataFrame:
    """Land a table as files in ``parts`` steps of ascending time and return them as a stream.

    Every step but the first also brings the last ``again`` of the step before a second
    time; the last one ends with a row, ``quiet`` after the latest time, with the values of
    ``heartbeat``: with it the watermark passes all rows. All files land before this
    returns; a micro-batch takes the files of one step.
    """
    micros = F.unix_micros(F.col(time_column))
    cuts = df.agg(F.percentile_approx(micros, [k / parts for k in range(parts + 1)], 1000)).first()[0]
    if not cuts:
        df.write.mode("append").parquet(path)
        return file_stream(df.sparkSession, path, files)
    beat = df.agg((F.max(time_column) + F.lit(quiet)).alias("_at")).select(*(
        F.col("_at").alias(f.name) if f.name == time_column else F.lit(heartbeat.get(f.name)).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ))
    since = cuts[0] - 1
    for step, (lo, hi) in enumerate(zip(cuts, cuts[1:]), start=1):
        rows = df.where((micros > since) & (micros <= hi))
        if step == parts:
            rows = rows.unionByName(beat)
        rows.repartition(files).write.mode("append").parquet(path)
        since = hi - int(again * (hi - lo))
    return file_stream(df.sparkSession, path, files)


# --- jobs ----------------------------------------------------------------------------------


def stream_billing(order_lines: DataFrame, items: DataFrame) -> DataFrame:
    """One pending bill per arriving order line, by a stream-static join."""
    return bills.priced_lines(order_lines, items).select(
        "booking_id", "item_id", "total_amount", F.lit("pending").alias("payment_status")
    )


def _checked_out(completed: DataFrame, delay: str) -> DataFrame:
    """First completion of every booking with the day it falls on.

    A stream that carries ``status_before`` settles on the step from ongoing alone.
    """
    done = completed.where(F.col("booking_status") == "completed")
    if "status_before" in completed.columns:
        done = done.where(F.col("status_before") == "ongoing")
    once = done.select("booking_id", "restaurant_id", "completed_at").withWatermark("completed_at", delay)
    return once.dropDuplicatesWithinWatermark(["booking_id"]).select(
        "booking_id", "restaurant_id", F.window("completed_at", "1 day").alias("day")
    )


def stream_settlement(
    completed: DataFrame, order_lines: DataFrame, items: DataFrame, restaurants: DataFrame, delay: str = "1 hour"
) -> DataFrame:
    """Price, tax, total and number of bills of each booking as it is checked out.

    ``completed`` (booking_id, restaurant_id, booking_status, completed_at) and
    ``order_lines`` (booking_id, item_id, quantity, order_time) are streams; a booking's
    orders and its check-out lie on one day. Lines are summed for each booking and day as
    they arrive, before any shuffle within a task, and the sums meet the check-outs in a
    stream-stream join on booking and day. State holds the open days only: a sum, a
    check-out and a duplicate's mark all go once the watermark has closed their day. No
    batch reads lines of an earlier one. A booking settles once, however often and in
    however many batches its completion is delivered, and one without orders has NULL
    totals and no bills.
    """
    use_rocksdb(order_lines.sparkSession)
    dated = order_lines.withWatermark("order_time", delay)
    cents = items.select("item_id", to_cents(F.col("price")).alias("_cents"))
    daily = (
        dated.join(cents, "item_id")
        .groupBy(F.window("order_time", "1 day").alias("day"), "booking_id")
        .agg(F.sum(F.col("_cents") * F.col("quantity")).alias("_sum"), F.count(F.lit(1)).alias("bills"))
    )
    met = _checked_out(completed, delay).join(daily, ["day", "booking_id"], "left_outer")
    priced = met.withColumn("price", from_cents(F.col("_sum"))).select("booking_id", "restaurant_id", "price", "bills")
    taxed = priced.join(restaurants.select("restaurant_id", "tax"), "restaurant_id", "left")
    return bills.total_columns(taxed, F.coalesce("bills", F.lit(0)).cast("bigint").alias("bills"))


def stream_paid_bills(completed: DataFrame, order_lines: DataFrame, items: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The bills that check-outs pay, each once, by a stream-stream join on booking and day."""
    use_rocksdb(order_lines.sparkSession)
    dated = order_lines.withWatermark("order_time", delay).withColumn("day", F.window("order_time", "1 day"))
    met = dated.join(_checked_out(completed, delay).select("day", "booking_id"), ["day", "booking_id"])
    return bills.priced_lines(met, items).select(
        "booking_id", "item_id", "quantity", "total_amount", F.lit("paid").alias("payment_status")
    )


def demand_tumbling(commands: DataFrame, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """T4: booking requests per tumbling window; a window is emitted once the watermark closes it."""
    return (
        commands.where(F.col("command") == "new_booking")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", size).alias("w"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "requests")
    )


def dedupe_commands(commands: DataFrame, delay: str = "1 hour") -> DataFrame:
    """T5: drop re-delivered commands whose first copy lies within the watermark delay."""
    return commands.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["command_id"])
