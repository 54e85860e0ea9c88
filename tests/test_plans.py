"""The shape of the physical plans: pruned scans, no nested loops, skew handled at run time."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seatledger.operators import lifecycle
from seatledger.plans import reports
from seatledger.plans.registry import all_queries
from seatledger.sources.star_schema import StarSchema
from seatledger.sources.tables import Database

BATCH = [q for q in all_queries() if not q.startswith("stream_")]
# These run jobs while being built; their last plan says little about them.
EAGER = {"cascade_delete_restaurant", "insert_defaults"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan as if every table were large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(BATCH) - EAGER))
def test_no_quadratic_joins(spark, sf_dir, no_broadcast, name):
    text = plan(all_queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(all_queries()["high_penalty_bookings"](spark, sf_dir))
    scans = dict(re.findall(r"(customer|orders)\.parquet.*?ReadSchema: struct<(.*?)>", text, re.S))
    assert set(scans["customer"].split(",")) == {"c_custkey:bigint", "c_name:string", "c_acctbal:double"}
    assert "o_totalprice" not in scans["orders"] and "o_orderstatus" not in scans["orders"]

    pushed = dict(re.findall(r"(customer|orders)\.parquet.*?PushedFilters: \[(.*?)\], ReadSchema", text, re.S))
    assert "LessThan(c_acctbal,0.0)" in pushed["customer"]

    text = plan(all_queries()["past_bookings"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in text
    assert "l_extendedprice" not in text and "l_shipdate" not in text


@pytest.mark.parametrize("name", ["completion_ratio_top3", "top_items_by_orders", "avg_duration_top10", "top_servers_global"])
def test_limits_do_not_sort_everything(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(all_queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["completion_ratio_top3", "avg_duration_top10", "busiest_slots", "top_items_by_orders"])
def test_facts_are_aggregated_before_they_are_shuffled(spark, sf_dir, no_broadcast, name):
    text = plan(all_queries()[name](spark, sf_dir))
    fact = "lineitem" if name == "top_items_by_orders" else "orders"
    # Read upwards from the fact scan: an aggregate comes before the first exchange.
    above = text[: text.index(f"{fact}.parquet")].splitlines()[::-1]
    first = next(l for l in above if "Exchange" in l or "HashAggregate" in l)
    assert "HashAggregate" in first


@pytest.fixture
def skew_conf(spark, no_broadcast):
    """Thresholds low enough for the skew handling to show on a small table."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def test_hot_member_is_split(spark, skew_conf):
    member = spark.range(2000).select(
        F.col("id").alias("member_id"), F.concat(F.lit("u"), "id").alias("username"),
        F.lit(Decimal("9.00")).alias("cancellation_penalty"),
    )
    booking = spark.range(0, 60000, 1, 16).select(
        F.col("id").alias("booking_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2000).alias("member_id"),
        F.lit(3).alias("start_time_slot"), F.lit("website").alias("booking_method"),
    )
    df = reports.high_penalty_bookings(Database({"member": member, "booking": booking}))
    assert df.agg(F.count("*")).collect()[0][0] == 60000
    rows = df.collect()
    assert len(rows) == 60000
    assert "skew=true" in plan(df)


def test_vacant_cells_do_not_meet_in_one_partition(spark, no_broadcast):
    """A grid that is almost all vacant spreads over the partitions of the release join."""
    from seatledger.operators.changes import release_slots

    grid = spark.range(20000).select(
        F.col("id").alias("table_id"), F.current_date().alias("service_date"), F.lit(1).alias("slot_id"),
        F.lit(None).cast("long").alias("booking_id"), F.lit("vacant").alias("status"),
    )
    status = spark.createDataFrame([(1, "cancelled")], "booking_id long, booking_status string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        released = release_slots(grid, status)
        sizes = [r["count"] for r in released.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 4


def test_release_shuffles_days_and_named_cells_only(spark, sf_dir, no_broadcast):
    """The grid is brought together by table and date; no cell is shuffled by its slot."""
    text = plan(all_queries()["release_slots"](spark, sf_dir))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)", text)
    assert shuffles and not any("slot_id" in keys for keys in shuffles)


def test_commands_without_a_key_do_not_meet_in_one_partition(spark, no_broadcast):
    """What looks nothing up, here every command, spreads over the partitions of the joins."""
    commands = spark.range(20000).selectExpr(
        "id as command_id", "timestamp '2024-01-01' as ts", "if(id < 0, 'order_food', 'new_booking') as command",
        *(f"if(id < 0, id, null) as {c}" for c in ("member_id", "booking_id", "restaurant_id", "item_id")),
        "date '2024-01-01' as service_date", "1 as start_time_slot", "1 as booking_duration",
    )
    one = spark.range(1, 2)
    state = one.selectExpr("id as booking_id", "id as member_id", "id as restaurant_id", "date '2024-01-01' as service_date", "'scheduled' as booking_status")
    menu = one.selectExpr("id as restaurant_id", "id as item_id", "true as availability")
    tables = one.selectExpr("id as table_id", "id as restaurant_id")
    masks = one.selectExpr("id as table_id", "date '2024-01-01' as service_date", "id as occupied_mask")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        decided = lifecycle.command_outcomes(commands, state, menu, tables, masks)
        sizes = [r["count"] for r in decided.groupBy("outcome", "message", F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and max(sizes) < 20000 / 4


def test_decisions_read_commands_once_and_bookings_twice(spark, sf_dir):
    db = StarSchema(spark, sf_dir)
    outcomes = lifecycle.command_outcomes(db.command, db.booking_state, db.menu, db.rtable, db.masks)
    plan = outcomes._jdf.queryExecution().optimizedPlan().toString()
    scans = {t: sum(f"{c}#" in line for line in plan.splitlines() if "Relation [" in line) for t, c in {
        "events": "event_id", "orders": "o_orderkey", "lineitem": "l_orderkey",
    }.items()}
    assert scans == {"events": 1, "orders": 2, "lineitem": 1}


@pytest.mark.parametrize("name", ["avg_total_by_item_active", "avg_total_by_item_active_dedup"])
def test_baskets_are_made_once(spark, sf_dir, no_broadcast, name):
    """Lines are read once and keep their place by booking for baskets and totals alike."""
    text = plan(all_queries()[name](spark, sf_dir))
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", text)) == 1


def test_only_menus_that_orders_ask_for_are_grouped(spark, sf_dir, no_broadcast):
    text = plan(all_queries()["validate_orders"](spark, sf_dir))
    assert "LeftSemi" in text
