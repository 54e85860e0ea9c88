from __future__ import annotations

from decimal import Decimal

import pytest

from fixtures import at, small_database
from seatledger.functions.expressions import log_message
from seatledger.plans import reports
from seatledger.schemas import DEFAULTS, NOW_DEFAULTS
from seatledger.session import checkpoint_root, scratch_path
from seatledger.sources import catalogue, generators
from seatledger.sources.tables import Database, append_table, read_table, reload_table, write_bucketed
from pyspark.sql import functions as F


def test_csv_ingest_normalises_and_defaults(spark, tmp_path):
    (tmp_path / "member.csv").write_text(
        "member_id,customer_id,username,first_name,last_name,email,phone_number,login_method,member_status,cancellation_penalty\n"
        "1,1,ann,Ann,A,a@x.org,1,WEBSITE,Just Member,\n"
        "2,2,ben,Ben,B,b@x.org,2,Walk-in,active,4.50\n"
    )
    got = read_table(spark, str(tmp_path / "member.csv"), "member", "csv").orderBy("member_id").collect()
    assert [(r.login_method, r.member_status, r.cancellation_penalty) for r in got] == [
        ("website", "just member", Decimal("0.00")), ("walk-in", "active", Decimal("4.50")),
    ]


def test_credentials_are_never_read(spark, tmp_path):
    path = str(tmp_path / "employee")
    spark.createDataFrame([(1, "secret", "Chef")], "employee_id long, password string, role string").write.parquet(path)
    assert "password" not in read_table(spark, path, "employee").columns


def test_append_and_reload(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string")
    append_table(df, path)
    append_table(df, path)
    assert spark.read.parquet(path).count() == 4
    reload_table(df, path)
    assert spark.read.parquet(path).count() == 2


def test_reload_touches_only_the_given_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    reload_table(spark.createDataFrame([(1, "a"), (2, "b")], "k long, p string"), path, ("p",))
    reload_table(spark.createDataFrame([(9, "b")], "k long, p string"), path, ("p",))
    assert sorted((r.k, r.p) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc", "csv"])
def test_database_round_trip(spark, tmp_path, fmt):
    db = small_database(spark)
    names = ["restaurant", "rtable", "employee", "member", "item", "menu", "shift"]
    for name in names:
        writer = db.tables()[name].write.format(fmt)
        (writer.option("header", "true") if fmt == "csv" else writer).save(str(tmp_path / name))
    loaded = Database.load(spark, str(tmp_path), fmt, names)
    for name in names:
        assert sorted(map(tuple, loaded.tables()[name].collect())) == sorted(map(tuple, db.tables()[name].collect()))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    state = spark.range(500).select(F.col("id").alias("booking_id"), (F.col("id") % 7).alias("restaurant_id"))
    lines = spark.range(2000).select((F.col("id") % 500).alias("booking_id"), F.col("id").alias("order_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_bucketed(state, "bucketed_booking", str(tmp_path / "b"), "booking_id", 4)
        write_bucketed(lines, "bucketed_line", str(tmp_path / "l"), "booking_id", 4)
        joined = spark.table("bucketed_line").join(spark.table("bucketed_booking"), "booking_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_booking")
        spark.sql("DROP TABLE IF EXISTS bucketed_line")


def test_time_slots(spark):
    got = [(r.slot_id, r.start_time) for r in generators.time_slots(spark).orderBy("slot_id").collect()]
    assert len(got) == 14 and got[0] == (1, "10:00:00") and got[-1] == (14, "23:00:00")
    half = generators.time_slots(spark, 9, 10, 30).orderBy("slot_id").collect()
    assert [r.start_time for r in half] == ["09:00:00", "09:30:00", "10:00:00"]
    assert generators.time_slots(spark, 12, 10).count() == 0


def test_message_is_null_when_an_id_is_missing(spark):
    no = F.lit(None).cast("bigint")
    df = spark.range(1).select(log_message(F.lit("checked_in"), F.lit(1), no, no, no).alias("m"))
    assert df.collect()[0].m is None


def test_scratch_lies_below_the_shared_folder(spark):
    root = checkpoint_root(spark)
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_reports_run_on_an_empty_database(spark):
    db = small_database(spark)
    for report in (reports.completion_ratio_top3, reports.avg_total_by_item_active, reports.top_items_by_orders,
                   reports.avg_revenue_per_booking, reports.active_member_website_bookings, reports.busiest_slots):
        assert report(db).count() == 0
    assert reports.member_booking_summary(db).count() == 4


def test_inserts_fill_declared_defaults_and_keep_given_nulls(spark, tmp_path):
    early = spark.createDataFrame([(1, at(1)), (2, at(2))], "booking_id long, seen timestamp")
    plain = {r.booking_id: r for r in catalogue.inserted(early, "booking_status", "seen").collect()}
    assert {r.booking_status for r in plain.values()} == {"scheduled"}
    times = dict(early.selectExpr("booking_id", "unix_timestamp(seen)").collect())
    stored = catalogue.inserted(early, "booking_status", "seen").selectExpr("booking_id", "unix_timestamp(last_activity)")
    assert dict(stored.collect()) == times and all(r.out_time is None and r.employee_id is None for r in plain.values())

    given = early.selectExpr("booking_id", "cast(null as string) booking_status", "cast(null as timestamp) last_activity")
    row = catalogue.inserted(given, "booking_status").first()
    assert row.booking_status is None and row.last_activity is None
    # Without an event time the clock dates the row; an empty insert stores nothing.
    assert catalogue.inserted(early.select("booking_id"), "booking_status").where("last_activity is null").isEmpty()
    assert catalogue.inserted(early.limit(0), "booking_status", "seen").isEmpty()
    with pytest.raises(ValueError):
        catalogue.inserted(early, "booking_status")

    # The definition stays while the table does, and fills later inserts too.
    name = catalogue.create_table(spark, "member", str(tmp_path / "member"), "kept_member")
    try:
        for k in (1, 2):
            catalogue.insert_rows(spark.createDataFrame([(k,)], "member_id long"), "member", name)
        assert spark.table(name).where("cancellation_penalty = 0 and username is null").count() == 2
    finally:
        spark.sql(f"DROP TABLE {name}")
    declared = {(t, c) for t in DEFAULTS for c in DEFAULTS[t]} | {(t, c) for t in NOW_DEFAULTS for c in NOW_DEFAULTS[t]}
    assert all(catalogue.default_clause(t, c) for t, c in declared)
