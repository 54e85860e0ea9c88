"""Views and functions for spark.sql text."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from fixtures import DAY, at, booking_request, frame, small_database
from seatledger.functions.sql import register_functions
from seatledger.plans import day
from seatledger.sources.relations import RELATIONS, RENAMED, create_views, load_relations

def test_questions_over_the_views(spark):
    """Statements over several views against the same counts from the frames themselves."""
    db = small_database(spark)
    create_views(db)
    ask = lambda text: sorted(map(tuple, spark.sql(text).collect()))
    seats = {}
    places = {r.restaurant_id: r.location for r in db.restaurant.collect()}
    for t in db.rtable.collect():
        seats[places[t.restaurant_id]] = seats.get(places[t.restaurant_id], 0) + 1
    assert ask("SELECT r.location, count(t.table_id) FROM RTables t JOIN restaurants r USING (restaurant_id) GROUP BY r.location") == sorted(seats.items())
    states = {}
    for b in db.billing.collect():
        states[b.payment_status] = states.get(b.payment_status, 0) + 1
    assert ask("SELECT payment_status, count(*) FROM Billing GROUP BY payment_status") == sorted(states.items())
    held = {r.booking_id for r in db.booking_status.collect() if r.booking_status in ("scheduled", "ongoing")}
    starts = [b.start_time_slot for b in db.booking.collect() if b.booking_id in held]
    want = sorted((s, starts.count(s)) for s in set(starts))
    assert ask(
        "SELECT b.start_time_slot, count(*) FROM Bookings b LEFT SEMI JOIN "
        "(SELECT booking_id FROM BookingStatus WHERE booking_status IN ('scheduled', 'ongoing')) s USING (booking_id) GROUP BY 1"
    ) == want


def test_every_relation_of_a_database_gets_a_view(spark):
    assert set(create_views(small_database(spark))) == {*RELATIONS, "BookingTotals"}
    assert spark.sql("SELECT count(*) AS n FROM TableStatus WHERE status = 'vacant'").collect()[0].n == 56


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql(
        "SELECT tax_amount(13.80, 8.25) AS t, price_after_tax(13.80, 8.25) AS p, "
        "price_after_tax(NULL, 8.25) AS n, slot_fits(13, 3, 14) AS f, slot_fits(13, 2, 14) AS g"
    ).collect()[0]
    assert (row.t, row.p, row.n, row.f, row.g) == (Decimal("1.14"), Decimal("14.94"), None, False, True)


def test_export_round_trip(spark, tmp_path):
    """Relations written as csv, 0/1 booleans and mixed case included, come back as the same database."""
    db = small_database(spark)
    lines = frame(spark, "order_line", [
        {"order_id": 5, "booking_id": 1, "item_id": 1, "quantity": 2, "order_time": at(1)}])
    db = db.replace(order_line=lines, billing=frame(spark, "billing", [
        {"order_id": 5, "booking_id": 1, "total_amount": Decimal("9.20"), "payment_status": "Paid"}]))
    for relation, name in RELATIONS.items():
        table = db.tables()[name]
        missing = {"booking": ["service_date"], "table_status": ["service_date"], "billing": ["booking_id"]}
        out = table.drop(*missing.get(name, [])).select(
            *[(F.col(c).cast("int") if c == "availability" else F.upper(c) if c == "role" else F.col(c))
              .alias(RENAMED.get(c, c)) for c in table.columns if c not in missing.get(name, [])])
        out.coalesce(1).write.option("header", "true").csv(str(tmp_path / relation))
    loaded = load_relations(spark, str(tmp_path), DAY)
    for name, table in db.tables().items():
        got = loaded.tables()[name]
        assert sorted(map(str, got.select(table.columns).collect())) == sorted(map(str, table.collect())), name
    _, outcome = day.book(loaded, frame(spark, "command", [booking_request(1, 1, 1, 3, 2)]))
    assert [(r.outcome, r.table_id) for r in outcome.collect()] == [("confirmed", 11)]
