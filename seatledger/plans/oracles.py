"""The registered queries as DuckDB SQL, written in the plain form the model states them in.

``VIEWS`` defines the booking tables over the star schema; each oracle names the views it
needs. The order-dependent keys recurse over each group's rows one by one.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "restaurant": """
        SELECT s_suppkey AS restaurant_id, s_name AS restaurant_name, n_name AS location,
               CAST(7.50 + 0.08 * n_nationkey AS DECIMAL(3,2)) AS tax
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "member": """
        SELECT c_custkey AS member_id, c_name AS username,
               split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'active'
                    WHEN c_mktsegment = 'FURNITURE' THEN 'cancelled' ELSE 'just member' END AS member_status,
               CASE WHEN c_acctbal < 0
                    THEN CAST(CAST(-c_acctbal AS DECIMAL(12,2)) * 0.01 AS DECIMAL(10,2))
                    ELSE CAST(0 AS DECIMAL(10,2)) END AS cancellation_penalty
        FROM customer""",
    "rtable": """
        SELECT s_suppkey * 10 + k AS table_id, s_suppkey AS restaurant_id
        FROM supplier, range(1, 11) r(k)""",
    "time_slot": """
        SELECT CAST(k AS INTEGER) AS slot_id, lpad(CAST(9 + k AS VARCHAR), 2, '0') || ':00:00' AS start_time
        FROM range(1, 15) r(k)""",
    "item": """
        SELECT p_partkey AS item_id, p_name AS item_name, CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM part""",
    "staff": """
        SELECT s_suppkey AS restaurant_id, s_suppkey * 5 + k AS employee_id,
               'Employee ' || CAST(s_suppkey * 5 + k AS VARCHAR) AS employee_name,
               CASE k WHEN 0 THEN 'chef' WHEN 3 THEN 'manager' ELSE 'server' END AS role,
               1 + k % 2 AS first_slot
        FROM supplier, range(0, 5) r(k)""",
    "booking_base": """
        SELECT o_orderkey AS booking_id, o_custkey AS member_id,
               o_orderkey % (SELECT count(*) FROM supplier) AS restaurant_id,
               CAST(1 + (o_orderkey // 7) % 14 AS INTEGER) AS start_time_slot,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS booking_duration,
               CASE o_orderkey % 3 WHEN 0 THEN 'website' WHEN 1 THEN 'walk-in' ELSE 'phone call' END
                   AS booking_method,
               o_orderdate AS booking_created,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS service_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'cancelled'
                    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'ongoing' ELSE 'scheduled' END END
                   AS booking_status
        FROM orders""",
    "booking": """
        SELECT *, restaurant_id * 10 + 1 + (booking_id // 11) % 10 AS table_id,
               CASE WHEN booking_status IN ('ongoing', 'completed')
                    THEN restaurant_id * 5 + (booking_id // 3) % 5 END AS employee_id
        FROM booking_base""",
    "order_line": """
        SELECT l_orderkey AS booking_id, l_partkey AS item_id, CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem""",
    "numbered_line": """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                           l_extendedprice) AS order_id,
               l_orderkey AS booking_id, l_partkey AS item_id, CAST(l_quantity AS INTEGER) AS quantity
        FROM lineitem""",
    "billing": """
        SELECT order_id, n.booking_id, CAST(price * quantity AS DECIMAL(18,2)) AS total_amount,
               CASE WHEN n.booking_id IN (SELECT booking_id FROM booking WHERE booking_status = 'completed')
                    THEN 'paid' ELSE 'pending' END AS payment_status
        FROM numbered_line n JOIN item USING (item_id)""",
    "price": """
        SELECT booking_id, CAST(sum(price * quantity) AS DECIMAL(18,2)) AS price
        FROM order_line JOIN item USING (item_id) GROUP BY booking_id""",
    "totals": """
        SELECT b.booking_id, b.booking_status, p.price AS total_price,
               CAST(p.price * r.tax * 0.01 AS DECIMAL(18,2)) AS total_tax,
               CAST(p.price + CAST(p.price * r.tax * 0.01 AS DECIMAL(18,2)) AS DECIMAL(18,2))
                   AS total_price_after_tax
        FROM booking b LEFT JOIN price p USING (booking_id) LEFT JOIN restaurant r USING (restaurant_id)""",
    "menu": """
        SELECT restaurant_id, item_id, item_id % 10 <> restaurant_id % 10 AS availability
        FROM (SELECT DISTINCT l_orderkey % (SELECT count(*) FROM supplier) AS restaurant_id,
                              l_partkey AS item_id FROM lineitem)""",
    "command": """
        SELECT event_id AS command_id, ts,
               CASE event_type WHEN 'signup' THEN 'new_booking' WHEN 'view' THEN 'member_in'
                    WHEN 'click' THEN 'order_food' WHEN 'purchase' THEN 'member_out'
                    WHEN 'error' THEN 'cancel_booking' END AS command,
               user_id AS member_id,
               CASE WHEN event_type IN ('click', 'error') THEN event_id * 2 END AS booking_id,
               CASE WHEN event_type = 'signup'
                    THEN event_id % (SELECT count(*) FROM supplier) END AS restaurant_id,
               CASE WHEN event_type = 'signup' THEN 1 + event_id % 14 END AS start_time_slot,
               CASE WHEN event_type = 'signup' THEN 1 + (event_id // 14) % 5 END AS booking_duration,
               CASE WHEN event_type = 'click' THEN event_id * 7 % (SELECT count(*) FROM part) END AS item_id,
               CASE WHEN event_type = 'click' THEN CAST(1 + event_id % 4 AS INTEGER) END AS quantity,
               CAST(date_trunc('month', ts - INTERVAL 312 MONTH) AS DATE) AS service_date
        FROM events""",
    "open_booking": "SELECT * FROM booking WHERE booking_status IN ('scheduled', 'ongoing')",
    "open_cell": """
        SELECT booking_id, table_id, service_date, CAST(s.k AS INTEGER) AS slot_id
        FROM open_booking, range(1, 15) s(k)
        WHERE s.k BETWEEN start_time_slot AND start_time_slot + booking_duration - 1""",
    "held_slot": """
        SELECT booking_id, table_id, service_date,
               CAST(unnest(range(start_time_slot, start_time_slot + booking_duration)) AS INTEGER) AS slot_id
        FROM open_booking""",
    "occupied_cell": "SELECT DISTINCT table_id, service_date, slot_id FROM open_cell",
    "ask": """
        SELECT booking_id AS request_id, restaurant_id, service_date, start_time_slot, booking_duration
        FROM booking WHERE booking_status = 'cancelled'""",
    "command_ask": """
        SELECT command_id AS request_id, restaurant_id, service_date, start_time_slot, booking_duration
        FROM command WHERE command = 'new_booking'""",
}

# Tables vacant in all slots of a shape: count the vacant cells and compare with the duration.
_VACANT = """
    shape AS (SELECT DISTINCT restaurant_id, service_date, start_time_slot, booking_duration FROM {ask}),
    free_table AS (
        SELECT restaurant_id, service_date, start_time_slot, booking_duration, table_id
        FROM shape JOIN rtable USING (restaurant_id), range(1, 15) s(k)
        WHERE s.k BETWEEN start_time_slot AND start_time_slot + booking_duration - 1
          AND NOT EXISTS (SELECT 1 FROM occupied_cell c
                          WHERE c.table_id = rtable.table_id AND c.service_date = shape.service_date
                            AND c.slot_id = s.k)
        GROUP BY ALL HAVING count(*) = booking_duration)"""

_REPLAY = """
    numbered AS (SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY ts, command_id) AS n FROM command),
    steps AS (
        SELECT member_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS command_id,
               CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS VARCHAR) AS command,
               'none' AS status_before, 'none' AS status_after, CAST(NULL AS BIGINT) AS booking_id,
               CAST(NULL AS VARCHAR) AS outcome
        FROM (SELECT DISTINCT member_id FROM command)
        UNION ALL
        SELECT c.member_id, c.n, c.command_id, c.ts, c.command, s.status_after,
               CASE WHEN c.command = 'new_booking' AND s.status_after NOT IN ('scheduled', 'ongoing')
                    THEN 'scheduled'
                    WHEN c.command = 'member_in' AND s.status_after = 'scheduled' THEN 'ongoing'
                    WHEN c.command = 'member_out' AND s.status_after = 'ongoing' THEN 'completed'
                    WHEN c.command = 'cancel_booking' AND s.status_after = 'scheduled' THEN 'cancelled'
                    ELSE s.status_after END,
               CASE WHEN c.command = 'new_booking' AND s.status_after NOT IN ('scheduled', 'ongoing')
                    THEN c.command_id ELSE s.booking_id END,
               CASE c.command
                    WHEN 'new_booking' THEN CASE WHEN s.status_after IN ('scheduled', 'ongoing')
                         THEN 'has_open_booking' ELSE 'confirmed' END
                    WHEN 'member_in' THEN CASE WHEN s.status_after = 'scheduled'
                         THEN 'checked_in' ELSE 'no_scheduled_booking' END
                    WHEN 'order_food' THEN CASE WHEN s.status_after = 'ongoing'
                         THEN 'accepted' ELSE 'invalid_booking' END
                    WHEN 'member_out' THEN CASE WHEN s.status_after = 'ongoing'
                         THEN 'checked_out' ELSE 'not_checked_in' END
                    ELSE CASE s.status_after WHEN 'none' THEN 'not_found' WHEN 'scheduled' THEN 'cancelled'
                         ELSE 'not_allowed' END END
        FROM steps s JOIN numbered c ON c.member_id = s.member_id AND c.n = s.n + 1)"""

_OUTCOMES = """
    held AS (SELECT member_id, min(booking_id) AS held_id FROM open_booking GROUP BY ALL),
    latest AS (SELECT member_id, booking_status, max(booking_id) AS own_id FROM open_booking GROUP BY ALL),
    first_free AS (SELECT restaurant_id, service_date, start_time_slot, booking_duration,
                          min(table_id) AS table_id FROM free_table GROUP BY ALL),
    outcomes AS (
        SELECT c.command_id, c.ts, c.command, c.member_id,
               CASE WHEN held_id IS NOT NULL THEN held_id WHEN f.table_id IS NOT NULL THEN c.command_id END
                   AS booking_id,
               c.restaurant_id, CAST(NULL AS BIGINT) AS item_id,
               CASE WHEN held_id IS NOT NULL THEN 'has_open_booking'
                    WHEN f.table_id IS NOT NULL THEN 'confirmed' ELSE 'no_table' END AS outcome
        FROM command c LEFT JOIN held USING (member_id)
             LEFT JOIN first_free f USING (restaurant_id, service_date, start_time_slot, booking_duration)
        WHERE c.command = 'new_booking'
        UNION ALL
        SELECT c.command_id, c.ts, c.command, c.member_id, own_id, NULL, NULL,
               CASE WHEN own_id IS NULL THEN 'no_scheduled_booking' ELSE 'checked_in' END
        FROM command c LEFT JOIN latest l ON l.member_id = c.member_id AND l.booking_status = 'scheduled'
        WHERE c.command = 'member_in'
        UNION ALL
        SELECT c.command_id, c.ts, c.command, c.member_id, own_id, NULL, NULL,
               CASE WHEN own_id IS NULL THEN 'not_checked_in' ELSE 'checked_out' END
        FROM command c LEFT JOIN latest l ON l.member_id = c.member_id AND l.booking_status = 'ongoing'
        WHERE c.command = 'member_out'
        UNION ALL
        SELECT c.command_id, c.ts, c.command, b.member_id, c.booking_id, b.restaurant_id, c.item_id,
               CASE WHEN b.booking_status = 'ongoing' THEN
                    CASE WHEN m.availability THEN 'accepted' ELSE 'item_unavailable' END
                    ELSE 'invalid_booking' END
        FROM command c LEFT JOIN booking b ON b.booking_id = c.booking_id
             LEFT JOIN menu m ON m.restaurant_id = b.restaurant_id AND m.item_id = c.item_id
        WHERE c.command = 'order_food'
        UNION ALL
        SELECT c.command_id, c.ts, c.command, b.member_id, c.booking_id, NULL, NULL,
               CASE WHEN b.booking_id IS NULL THEN 'not_found'
                    WHEN b.booking_status = 'scheduled' THEN 'cancelled' ELSE 'not_allowed' END
        FROM command c LEFT JOIN booking b ON b.booking_id = c.booking_id
        WHERE c.command = 'cancel_booking')"""

_CANCELLATIONS = """
    ranked AS (SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY ts, command_id) AS turn
               FROM command WHERE command = 'cancel_booking'),
    cancellation AS (
        SELECT r.command_id, r.ts, r.booking_id, b.member_id, b.booking_status AS current_status,
               CASE WHEN b.booking_id IS NULL THEN 'not_found'
                    WHEN b.booking_status = 'scheduled' AND turn = 1 THEN 'cancelled'
                    ELSE 'not_allowed' END AS outcome
        FROM ranked r LEFT JOIN booking b USING (booking_id))"""

# Least-loaded employee whose shift has started, per booking.
_SNAPSHOT = """
    load AS (SELECT employee_id, count(*) AS load FROM booking
             WHERE booking_status = 'ongoing' GROUP BY employee_id),
    choice AS (
        SELECT booking_id, employee_id FROM (
            SELECT b.booking_id, s.employee_id,
                   row_number() OVER (PARTITION BY b.booking_id
                                      ORDER BY load NULLS FIRST, s.employee_id) AS pick
            FROM booking b JOIN staff s ON s.restaurant_id = b.restaurant_id
                 AND s.first_slot <= b.start_time_slot
                 LEFT JOIN load l ON l.employee_id = s.employee_id
            WHERE b.booking_status = 'scheduled')
        WHERE pick = 1)"""


# Check-ins one by one per restaurant, the roster's loads carried along as a list.
_SERVED = """
    load AS (SELECT employee_id, count(*) AS load FROM booking
             WHERE booking_status = 'ongoing' GROUP BY employee_id),
    arrival AS (SELECT *, row_number() OVER (PARTITION BY restaurant_id
                                             ORDER BY booking_created, booking_id) AS n
                FROM booking WHERE booking_status = 'scheduled'),
    served AS (
        SELECT restaurant_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS booking_id,
               CAST(NULL AS INTEGER) AS start_time_slot, CAST(NULL AS BIGINT) AS employee_id,
               list({'load': coalesce(load, 0), 'employee_id': s.employee_id, 'first_slot': first_slot}) AS loads
        FROM staff s LEFT JOIN load USING (employee_id) GROUP BY restaurant_id
        UNION ALL
        SELECT restaurant_id, n, booking_id, start_time_slot, pick.employee_id,
               list_transform(loads, lambda e: {
                   'load': CASE WHEN e.employee_id = pick.employee_id THEN e.load + 1 ELSE e.load END,
                   'employee_id': e.employee_id, 'first_slot': e.first_slot})
        FROM (SELECT a.restaurant_id, a.n, a.booking_id, a.start_time_slot, s.loads,
                     list_sort(list_filter(s.loads, lambda e: e.first_slot <= a.start_time_slot))[1] AS pick
              FROM served s JOIN arrival a ON a.restaurant_id = s.restaurant_id AND a.n = s.n + 1))"""

# Requests one by one per service date, the bookings made so far carried along as a list.
_ALLOCATED = """
    held AS (SELECT member_id, service_date, min(booking_id) AS held_id FROM open_booking GROUP BY ALL),
    choices AS (SELECT restaurant_id, service_date, start_time_slot, booking_duration,
                       list(table_id ORDER BY table_id) AS tables FROM free_table GROUP BY ALL),
    request AS (
        SELECT b.booking_id AS request_id, b.booking_created AS ts, b.member_id, b.restaurant_id, b.service_date,
               b.start_time_slot, b.booking_duration, held_id, coalesce(tables, []) AS tables,
               row_number() OVER (PARTITION BY b.service_date ORDER BY b.booking_created, b.booking_id) AS n
        FROM booking b LEFT JOIN held USING (member_id, service_date)
             LEFT JOIN choices USING (restaurant_id, service_date, start_time_slot, booking_duration)
        WHERE b.booking_status = 'cancelled'),
    decided AS (
        SELECT service_date, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS request_id,
               CAST(NULL AS BIGINT) AS table_id, CAST(NULL AS BIGINT) AS existing_booking_id,
               CAST([] AS STRUCT(request_id BIGINT, member_id BIGINT, table_id BIGINT, lo INTEGER, hi INTEGER)[])
                   AS made
        FROM (SELECT DISTINCT service_date FROM request)
        UNION ALL
        SELECT service_date, n, request_id, table_id, existing_id,
               CASE WHEN table_id IS NULL THEN made
                    ELSE list_append(made, {'request_id': request_id, 'member_id': member_id,
                                            'table_id': table_id, 'lo': lo, 'hi': hi}) END
        FROM (SELECT *, CASE WHEN existing_id IS NULL THEN
                   list_filter(tables, lambda t: len(list_filter(made, lambda m:
                       m.table_id = t AND m.lo <= hi AND m.hi >= lo)) = 0)[1] END AS table_id
              FROM (SELECT r.service_date, r.n, r.request_id, r.member_id, r.tables, d.made,
                           r.start_time_slot AS lo, r.start_time_slot + r.booking_duration - 1 AS hi,
                           coalesce(r.held_id, list_filter(d.made, lambda m: m.member_id = r.member_id)[1].request_id)
                               AS existing_id
                    FROM decided d JOIN request r ON r.service_date = d.service_date AND r.n = d.n + 1)))"""


# The same with a gate across dates: members who hold a booking are out at once, all others
# form one sequence.
_ALLOCATED_BY_MEMBER = """
    held AS (SELECT member_id, min(booking_id) AS held_id FROM open_booking GROUP BY ALL),
    choices AS (SELECT restaurant_id, service_date, start_time_slot, booking_duration,
                       list(table_id ORDER BY table_id) AS tables FROM free_table GROUP BY ALL),
    request AS (
        SELECT b.booking_id AS request_id, b.booking_created AS ts, b.member_id, b.restaurant_id, b.service_date,
               b.start_time_slot, b.booking_duration, held_id, coalesce(tables, []) AS tables,
               row_number() OVER (PARTITION BY held_id IS NULL ORDER BY b.booking_created, b.booking_id) AS n
        FROM booking b LEFT JOIN held USING (member_id)
             LEFT JOIN choices USING (restaurant_id, service_date, start_time_slot, booking_duration)
        WHERE b.booking_status = 'cancelled'),
    walked AS (
        SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS request_id, CAST(NULL AS BIGINT) AS table_id,
               CAST(NULL AS BIGINT) AS existing_booking_id,
               CAST([] AS STRUCT(request_id BIGINT, member_id BIGINT, table_id BIGINT, date DATE, lo INTEGER, hi INTEGER)[])
                   AS made
        UNION ALL
        SELECT n, request_id, table_id, existing_id,
               CASE WHEN table_id IS NULL THEN made
                    ELSE list_append(made, {'request_id': request_id, 'member_id': member_id, 'table_id': table_id,
                                            'date': date, 'lo': lo, 'hi': hi}) END
        FROM (SELECT *, CASE WHEN existing_id IS NULL THEN
                   list_filter(tables, lambda t: len(list_filter(made, lambda m:
                       m.table_id = t AND m.date = date AND m.lo <= hi AND m.hi >= lo)) = 0)[1] END AS table_id
              FROM (SELECT r.n, r.request_id, r.member_id, r.tables, d.made, CAST(r.service_date AS DATE) AS date,
                           r.start_time_slot AS lo, r.start_time_slot + r.booking_duration - 1 AS hi,
                           list_filter(d.made, lambda m: m.member_id = r.member_id)[1].request_id AS existing_id
                    FROM walked d JOIN request r ON r.held_id IS NULL AND r.n = d.n + 1))),
    decided AS (
        SELECT request_id, table_id, existing_booking_id FROM walked WHERE n > 0
        UNION ALL SELECT request_id, NULL, held_id FROM request WHERE held_id IS NOT NULL)"""


def _turns(command: str, status: str, done: str, refused: str) -> str:
    return f"""
    turn AS (SELECT command_id, ts, member_id,
                    row_number() OVER (PARTITION BY member_id ORDER BY ts, command_id) AS k
             FROM command WHERE command = '{command}'),
    queue AS (SELECT member_id, booking_id,
                     row_number() OVER (PARTITION BY member_id ORDER BY booking_id DESC) AS k
              FROM booking WHERE booking_status = '{status}'),
    moved AS (SELECT command_id, ts, t.member_id, booking_id,
                     CASE WHEN booking_id IS NULL THEN '{refused}' ELSE '{done}' END AS outcome
              FROM turn t LEFT JOIN queue q ON q.member_id = t.member_id AND q.k = t.k)"""


def _sql(views: str, body: str, *extra: str, recursive: bool = False) -> str:
    wanted = views.split()
    parts = [f"{v} AS ({VIEWS[v]})" for v in wanted] + list(extra)
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) if parts else ""
    return f"{head}\n{body}"


_BK = "booking_base booking"
_MEAN = "CAST(CAST(sum({0}) AS DECIMAL(38,2)) AS DOUBLE) / count({0})"


def _finding(rule: str, table: str, key: str, n: str = "count(*)") -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST({key} AS VARCHAR) AS key, "
        f"CAST({n} AS BIGINT) AS n"
    )


def _repeated(rule: str, table: str, view: str, key: str) -> str:
    return f"{_finding(rule, table, key)} FROM {view} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1"


def _dangling(table: str, view: str, column: str, parent: str, parent_key: str) -> str:
    return (
        f"{_finding('foreign_key:' + column, table, column)} FROM {view} "
        f"WHERE {column} NOT IN (SELECT {parent_key} FROM {parent}) GROUP BY {column}"
    )


def _outside(table: str, view: str, column: str, allowed: str) -> str:
    return (
        f"{_finding('domain:' + column, table, column)} FROM {view} "
        f"WHERE lower({column}) NOT IN ({allowed}) GROUP BY {column}"
    )


def _count_rule(rule: str, table: str, column: str, view: str, test: str) -> str:
    return f"{_finding(rule + ':' + column, table, repr(column))} FROM {view} WHERE {test} HAVING count(*) > 0"


def _union(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}

    # --- reports
    q["active_member_website_bookings"] = _sql(f"restaurant member {_BK}", """
        SELECT first_name, last_name, email, booking_method, restaurant_name, location
        FROM member JOIN booking USING (member_id) JOIN restaurant USING (restaurant_id)
        WHERE member_status = 'active' AND booking_method = 'website'""")
    q["avg_revenue_as_written"] = _sql(f"restaurant item {_BK} numbered_line billing", f"""
        SELECT b.restaurant_id, restaurant_name, {_MEAN.format('total_amount')} AS avg_revenue_per_booking
        FROM booking b JOIN billing l ON b.booking_id = l.order_id
             JOIN restaurant r ON r.restaurant_id = b.restaurant_id
        GROUP BY b.restaurant_id, restaurant_name""")
    q["avg_revenue_per_booking"] = _sql(f"restaurant item {_BK} order_line price", f"""
        SELECT b.restaurant_id, restaurant_name, {_MEAN.format('price')} AS avg_revenue_per_booking
        FROM booking b JOIN price USING (booking_id) JOIN restaurant r ON r.restaurant_id = b.restaurant_id
        GROUP BY b.restaurant_id, restaurant_name""")
    q["top_items_by_orders"] = _sql("item order_line", """
        SELECT item_id, item_name, count(*) AS total_orders FROM order_line JOIN item USING (item_id)
        GROUP BY item_id, item_name ORDER BY total_orders DESC, item_id LIMIT 15""")
    q["member_booking_summary"] = _sql(f"member {_BK}", """
        SELECT m.member_id, username, count(b.booking_id) AS total_bookings,
               CAST(sum(CASE WHEN booking_status = 'cancelled' THEN 1 ELSE 0 END) AS BIGINT)
                   AS total_cancellations,
               cancellation_penalty
        FROM member m LEFT JOIN booking b ON b.member_id = m.member_id
        GROUP BY m.member_id, username, cancellation_penalty""")
    q["high_penalty_bookings"] = _sql(f"member {_BK}", """
        SELECT username, booking_id, start_time_slot, booking_method, cancellation_penalty
        FROM member JOIN booking USING (member_id) WHERE cancellation_penalty > 4""")
    q["avg_duration_top10"] = _sql(f"restaurant {_BK}", """
        SELECT restaurant_name, CAST(sum(booking_duration) AS DOUBLE) / count(booking_duration) AS avg_duration
        FROM booking JOIN restaurant USING (restaurant_id) GROUP BY restaurant_name
        ORDER BY avg_duration DESC NULLS LAST, restaurant_name LIMIT 10""")
    line_join = """
        FROM totals t JOIN booking b USING (booking_id) JOIN member USING (member_id)
             JOIN {lines} o ON o.booking_id = b.booking_id JOIN item USING (item_id)
        WHERE t.booking_status = 'completed' AND member_status = 'active' GROUP BY item_name"""
    mean_total = f"SELECT item_name, {_MEAN.format('total_price_after_tax')} AS avg_total_price_after_tax"
    seven = f"restaurant member item {_BK} order_line price totals"
    q["avg_total_by_item_active"] = _sql(seven, mean_total + line_join.format(lines="order_line"))
    q["avg_total_by_item_active_dedup"] = _sql(
        seven, mean_total + line_join.format(lines="(SELECT DISTINCT booking_id, item_id FROM order_line)"))
    q["completion_ratio_top3"] = _sql(f"restaurant {_BK}", """
        SELECT restaurant_name,
               CAST(count(CASE WHEN booking_status = 'completed' THEN 1 END) AS DOUBLE) / count(*)
                   AS completion_ratio
        FROM restaurant JOIN booking USING (restaurant_id) GROUP BY restaurant_name
        ORDER BY completion_ratio DESC, restaurant_name LIMIT 3""")
    q["top_servers_global"] = _sql(f"restaurant staff {_BK}", """
        SELECT restaurant_name, employee_name, count(booking_id) AS total_bookings_served
        FROM staff s JOIN booking b ON s.restaurant_id = b.restaurant_id AND role = 'server'
             JOIN restaurant r ON r.restaurant_id = b.restaurant_id
        GROUP BY restaurant_name, employee_name
        ORDER BY restaurant_name, total_bookings_served DESC, employee_name LIMIT 10""")
    q["top_server_per_restaurant"] = _sql(f"restaurant staff {_BK}", """
        SELECT restaurant_id, restaurant_name, employee_id, employee_name, total_bookings_served FROM (
            SELECT b.restaurant_id, restaurant_name, s.employee_id, employee_name,
                   count(*) AS total_bookings_served,
                   row_number() OVER (PARTITION BY b.restaurant_id
                                      ORDER BY count(*) DESC, s.employee_id) AS place
            FROM booking b JOIN staff s ON s.employee_id = b.employee_id AND role = 'server'
                 JOIN restaurant r ON r.restaurant_id = b.restaurant_id
            GROUP BY b.restaurant_id, restaurant_name, s.employee_id, employee_name)
        WHERE place = 1""")
    q["busiest_slots"] = _sql(f"time_slot {_BK}", """
        SELECT start_time, count(*) AS total_bookings
        FROM booking JOIN time_slot ON start_time_slot = slot_id GROUP BY start_time""")

    # --- generators and ingest
    q["gen_time_slots"] = _sql(f"time_slot {_BK}", """
        SELECT service_date, slot_id, start_time
        FROM (SELECT DISTINCT service_date FROM booking) CROSS JOIN time_slot""")
    q["gen_availability_grid"] = _sql("rtable time_slot", """
        SELECT table_id, slot_id, CAST(NULL AS BIGINT) AS booking_id, 'vacant' AS status
        FROM rtable CROSS JOIN time_slot""")
    q["ingest_defaults"] = """
        SELECT o_orderkey AS booking_id,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'cancelled' ELSE 'scheduled' END
                   AS booking_status
        FROM orders"""
    month = "strftime({}, '%Y-%m')".format
    q["insert_defaults"] = _sql(f"item member {_BK} order_line time_slot", """
        SELECT arrival, column_name, value, count(*) AS n FROM (
            SELECT 'member' AS arrival, 'cancellation_penalty' AS column_name, '0.00' AS value FROM member
            UNION ALL SELECT 'booking', 'booking_created', """ + month("booking_created") + """ FROM booking
            UNION ALL SELECT 'table_status', 'status', 'vacant'
                      FROM (SELECT DISTINCT table_id, service_date FROM booking), time_slot
            UNION ALL SELECT 'booking_status', 'booking_status', 'scheduled' FROM booking
            UNION ALL SELECT 'booking_status', 'last_activity', """ + month("booking_created") + """ FROM booking
            UNION ALL SELECT 'booking_status, given', 'booking_status', 'cancelled' FROM booking
                      WHERE booking_status = 'cancelled'
            UNION ALL SELECT 'booking_status, given', 'last_activity', NULL FROM booking
                      WHERE booking_status = 'cancelled'
            UNION ALL SELECT 'order_line', 'order_time', """ + month("l_shipdate") + """ FROM lineitem
            UNION ALL SELECT 'billing', 'payment_status', 'pending' FROM order_line JOIN item USING (item_id)
            UNION ALL SELECT 'program_log', 'log_timestamp', """ + month("ts") + """ FROM events)
        GROUP BY ALL""")
    q["dense_keys"] = """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                           l_extendedprice) AS order_id,
               l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem"""

    # --- billing
    q["booking_price"] = _sql(f"item {_BK} order_line price", """
        SELECT booking_id, price FROM booking LEFT JOIN price USING (booking_id)""")
    totals = "SELECT booking_id, total_price, total_tax, total_price_after_tax FROM totals"
    money = f"restaurant item {_BK} order_line price totals"
    q["booking_totals"] = _sql(money, totals)
    q["past_bookings"] = _sql(money, totals + " WHERE booking_status = 'completed'")
    q["stream_settlement"] = _sql(money, """
        SELECT booking_id, total_price, total_tax, total_price_after_tax,
               (SELECT count(*) FROM order_line o WHERE o.booking_id = totals.booking_id) AS bills
        FROM totals WHERE booking_status = 'completed'""")
    q["stream_paid_bills"] = _sql(f"item {_BK} order_line", """
        SELECT booking_id, item_id, quantity, CAST(price * quantity AS DECIMAL(18,2)) AS total_amount,
               'paid' AS payment_status
        FROM order_line JOIN item USING (item_id) JOIN booking USING (booking_id)
        WHERE booking_status = 'completed'""")
    bill = f"item {_BK} numbered_line billing"
    q["billing_from_orders"] = _sql(
        bill, "SELECT order_id, booking_id, total_amount, 'pending' AS payment_status FROM billing")
    q["settle_bills"] = _sql(bill, "SELECT order_id, booking_id, total_amount, payment_status FROM billing")
    q["stream_billing"] = _sql("item order_line", """
        SELECT booking_id, item_id, CAST(price * quantity AS DECIMAL(18,2)) AS total_amount,
               'pending' AS payment_status
        FROM order_line JOIN item USING (item_id)""")

    # --- availability and occupation
    q["booking_slot_occupancy"] = _sql(
        f"{_BK} open_booking held_slot", "SELECT booking_id, table_id, service_date, slot_id FROM held_slot")
    q["occupy_slots"] = _sql(f"{_BK} open_booking open_cell time_slot", """
        SELECT g.table_id, g.service_date, g.slot_id, max(c.booking_id) AS booking_id,
               CASE WHEN max(c.booking_id) IS NULL THEN 'vacant' ELSE 'occupied' END AS status
        FROM (SELECT DISTINCT table_id, service_date, slot_id FROM booking, time_slot) g
             LEFT JOIN open_cell c USING (table_id, service_date, slot_id)
        GROUP BY ALL""")
    q["release_slots"] = _sql(f"{_BK} time_slot", """
        SELECT g.table_id, g.service_date, g.slot_id,
               CASE WHEN s.booking_status = 'cancelled' THEN NULL ELSE w.booking_id END AS booking_id,
               CASE WHEN s.booking_status IN ('scheduled', 'ongoing') THEN 'occupied' ELSE 'vacant' END AS status
        FROM (SELECT DISTINCT table_id, service_date, slot_id FROM booking, time_slot) g
             LEFT JOIN (SELECT table_id, service_date, k AS slot_id, max(booking_id) AS booking_id
                        FROM booking, range(1, 15) r(k)
                        WHERE k BETWEEN start_time_slot AND start_time_slot + booking_duration - 1
                        GROUP BY ALL) w USING (table_id, service_date, slot_id)
             LEFT JOIN booking s ON s.booking_id = w.booking_id""")
    q["initial_booking_status"] = _sql(_BK, """
        SELECT booking_id, 'scheduled' AS booking_status, CAST(NULL AS BIGINT) AS employee_id,
               booking_created AS last_activity FROM booking""")
    search = f"{_BK} rtable open_booking open_cell occupied_cell"
    q["available_tables"] = _sql(
        f"{search} ask",
        "SELECT restaurant_id, service_date, start_time_slot, booking_duration, table_id FROM free_table",
        _VACANT.format(ask="ask"))
    q["find_available_table"] = _sql(f"{search} ask", """
        SELECT request_id, restaurant_id, service_date, min(table_id) AS table_id,
               count(table_id) AS available_count
        FROM ask LEFT JOIN free_table USING (restaurant_id, service_date, start_time_slot, booking_duration)
        GROUP BY request_id, restaurant_id, service_date""", _VACANT.format(ask="ask"))

    allocated = """
        SELECT d.request_id, r.ts, r.member_id, r.restaurant_id, r.service_date, r.start_time_slot,
               r.booking_duration, d.table_id,
               CASE WHEN d.existing_booking_id IS NOT NULL THEN 'has_open_booking'
                    WHEN d.table_id IS NOT NULL THEN 'confirmed' ELSE 'no_table' END AS outcome,
               d.existing_booking_id
        FROM decided d JOIN request r USING (request_id)"""
    vacant_ask = _VACANT.format(ask="ask")
    q["allocate_bookings"] = _sql(f"{search} ask", allocated, vacant_ask, _ALLOCATED_BY_MEMBER, recursive=True)
    q["allocate_bookings_per_date"] = _sql(f"{search} ask", allocated, vacant_ask, _ALLOCATED, recursive=True)

    # --- staffing
    q["staff_load"] = _sql(f"staff {_BK}", """
        SELECT s.employee_id, load FROM staff s LEFT JOIN (
            SELECT employee_id, count(*) AS load FROM booking WHERE booking_status = 'ongoing'
            GROUP BY employee_id) USING (employee_id)""")
    q["eligible_staff"] = _sql(f"staff {_BK}", """
        SELECT b.booking_id, b.restaurant_id, b.start_time_slot, count(s.employee_id) AS eligible,
               min(s.employee_id) AS first_employee_id
        FROM booking b LEFT JOIN staff s ON s.restaurant_id = b.restaurant_id
             AND s.first_slot <= b.start_time_slot
        GROUP BY ALL""")
    q["assign_staff_snapshot"] = _sql(f"staff {_BK}", """
        SELECT booking_id, restaurant_id, start_time_slot, c.employee_id
        FROM booking b LEFT JOIN choice c USING (booking_id) WHERE booking_status = 'scheduled'""", _SNAPSHOT)
    q["assign_staff_ordered"] = _sql(f"staff {_BK}", """
        SELECT restaurant_id, booking_id, start_time_slot, employee_id FROM served WHERE n > 0""",
        _SERVED, recursive=True)

    # --- lifecycle
    q["members_with_open_booking"] = _sql(f"{_BK} open_booking", """
        SELECT member_id, min(booking_id) AS existing_booking_id FROM open_booking GROUP BY member_id""")
    q["latest_open_booking"] = _sql(f"{_BK} open_booking", """
        SELECT member_id, booking_status, booking_id FROM (
            SELECT *, row_number() OVER (PARTITION BY member_id, booking_status
                                         ORDER BY booking_id DESC) AS place FROM open_booking)
        WHERE place = 1""")
    moved = "SELECT command_id, ts, member_id, booking_id, outcome FROM moved"
    q["member_checkins"] = _sql(
        f"{_BK} command", moved, _turns("member_in", "scheduled", "checked_in", "no_scheduled_booking"))
    q["member_checkouts"] = _sql(
        f"{_BK} command", moved, _turns("member_out", "ongoing", "checked_out", "not_checked_in"))
    q["validate_cancellations"] = _sql(f"{_BK} command", """
        SELECT command_id, ts, booking_id, member_id, current_status, outcome FROM cancellation""", _CANCELLATIONS)
    q["cancellation_penalties"] = _sql(f"member {_BK} command", """
        SELECT m.member_id, cancellation_penalty AS penalty_before, count(c.booking_id) AS cancellations,
               CAST(cancellation_penalty + 2 * count(c.booking_id) AS DECIMAL(18,2)) AS penalty_after
        FROM member m LEFT JOIN cancellation c ON c.member_id = m.member_id AND c.outcome = 'cancelled'
        GROUP BY m.member_id, cancellation_penalty""", _CANCELLATIONS)
    q["validate_orders"] = _sql(f"{_BK} menu command", """
        SELECT c.command_id, c.ts, c.booking_id, b.member_id, b.restaurant_id, c.item_id, c.quantity,
               CASE WHEN b.booking_status = 'ongoing' THEN
                    CASE WHEN m.availability THEN 'accepted' ELSE 'item_unavailable' END
                    ELSE 'invalid_booking' END AS outcome
        FROM command c LEFT JOIN booking b ON b.booking_id = c.booking_id
             LEFT JOIN menu m ON m.restaurant_id = b.restaurant_id AND m.item_id = c.item_id
        WHERE c.command = 'order_food'""")
    q["apply_status_changes"] = _sql(f"staff {_BK}", """
        SELECT b.booking_id,
               CASE WHEN l.booking_id IS NOT NULL THEN 'ongoing' ELSE b.booking_status END AS booking_status,
               CASE WHEN l.booking_id IS NOT NULL THEN c.employee_id ELSE b.employee_id END AS employee_id
        FROM booking b
             LEFT JOIN (SELECT max(booking_id) AS booking_id FROM booking
                        WHERE booking_status = 'scheduled' GROUP BY member_id) l USING (booking_id)
             LEFT JOIN choice c USING (booking_id)""", _SNAPSHOT)
    judged = f"{_BK} rtable menu command open_booking open_cell occupied_cell command_ask"
    vacant = _VACANT.format(ask="command_ask")
    q["command_outcomes"] = _sql(judged, """
        SELECT command_id, ts, command, member_id, booking_id, restaurant_id, item_id, outcome,
               CASE outcome
               WHEN 'has_open_booking' THEN 'Member already has a scheduled booking. Please handle existing booking (ID:'
                                            || booking_id || ') before creating a new one.'
               WHEN 'confirmed' THEN 'Booking Confirmed'
               WHEN 'no_table' THEN 'No available table found for the requested time slot.'
               WHEN 'checked_in' THEN 'has checked-in.'
               WHEN 'no_scheduled_booking' THEN 'No scheduled booking found for member ID'
               WHEN 'not_checked_in' THEN ' has not checked in.'
               WHEN 'cancelled' THEN 'Order cancelled successfully.'
               WHEN 'not_allowed' THEN 'Order cancellation not allowed.'
               WHEN 'not_found' THEN 'Order does not exist.'
               WHEN 'accepted' THEN 'Order recieved'
               WHEN 'item_unavailable' THEN 'MenuItem is unavailable'
               WHEN 'invalid_booking' THEN 'Not a valid Booking ID' END AS message
        FROM outcomes""", vacant, _OUTCOMES)
    q["audit_log_messages"] = _sql(judged, """
        SELECT command_id AS log_id, ts AS log_timestamp,
               CASE outcome
               WHEN 'has_open_booking' THEN 'Member ID: ' || member_id || ' with existing booking with id ' || booking_id || ' tried new booking. FAILED!!'
               WHEN 'confirmed' THEN 'Booking with ID ' || booking_id || ' created for member ID' || member_id || '. SUCCESS!!'
               WHEN 'no_table' THEN 'No table found for Member ID' || member_id || '. FAILED!!'
               WHEN 'checked_in' THEN 'Member ID ' || member_id || ' with booking ID ' || booking_id || ' has checked in. SUCCESS!!'
               WHEN 'no_scheduled_booking' THEN 'Member ID ' || member_id || ' with no booking tried checking in. FAILED!!'
               WHEN 'checked_out' THEN 'Member ID ' || member_id || ' with booking ID ' || booking_id || ' has checked out. SUCCESS!!'
               WHEN 'not_checked_in' THEN 'Member ID ' || member_id || ' with no valid booking tried checking out. FAILED!!'
               WHEN 'cancelled' THEN 'Booking ID ' || booking_id || ' by member ID ' || member_id || ' is CANCELLED!!'
               WHEN 'not_allowed' THEN 'Booking ID ' || booking_id || ' by member ID ' || member_id || ' tried cancelling. FAILED!!'
               WHEN 'not_found' THEN 'Booking ID ' || booking_id || ' does not eexist and cannot be cancelled. FAILED!!'
               WHEN 'item_unavailable' THEN 'MenuItem ID ' || item_id || ' at restaurant ID ' || restaurant_id || ' was not available for booking ID ' || booking_id || '. FAILED!!'
               WHEN 'invalid_booking' THEN 'Booking ID ' || booking_id || ' which is not a valid tried ordering food. FAILED!!'
               END AS message
        FROM outcomes WHERE outcome <> 'accepted'""", vacant, _OUTCOMES)
    q["lifecycle_replay"] = _sql("command", """
        SELECT command_id, ts, member_id, command, booking_id, status_before, status_after, outcome
        FROM steps WHERE n > 0""", _REPLAY, recursive=True)
    q["stream_lifecycle"] = q["lifecycle_replay"]
    q["completed_transitions"] = _sql("command", """
        SELECT booking_id, member_id, ts AS completed_at FROM steps
        WHERE status_before = 'ongoing' AND status_after = 'completed'""", _REPLAY, recursive=True)
    q["last_activity"] = _sql("command", """
        SELECT booking_id, max(ts) AS last_activity FROM steps
        WHERE status_before <> status_after GROUP BY booking_id""", _REPLAY, recursive=True)

    # --- cascade
    def left(table: str, view: str, key: str, gone: str) -> str:
        return f"SELECT '{table}' AS table_name, count(*) AS remaining FROM {view} WHERE {key} NOT IN ({gone})"

    closed = "SELECT restaurant_id FROM restaurant WHERE location = 'NATION_7'"
    lost = f"SELECT booking_id FROM booking WHERE restaurant_id IN ({closed})"
    q["cascade_delete_restaurant"] = _sql(f"restaurant rtable staff item {_BK} order_line menu", _union(
        left("restaurant", "restaurant", "restaurant_id", closed),
        left("rtable", "rtable", "restaurant_id", closed),
        left("booking", "booking", "booking_id", lost),
        left("booking_status", "booking", "booking_id", lost),
        left("order_line", "order_line", "booking_id", lost),
        left("billing", "order_line JOIN item USING (item_id)", "booking_id", lost),
        left("menu", "menu", "restaurant_id", closed),
        left("shift", "staff", "restaurant_id", closed)))

    # --- audits
    q["audit_primary_keys"] = _sql(f"restaurant rtable staff member item {_BK}", _union(
        _repeated("primary_key", "restaurant", "restaurant", "restaurant_id"),
        _repeated("primary_key", "rtable", "rtable", "table_id"),
        _repeated("primary_key", "employee", "staff", "employee_id"),
        _repeated("primary_key", "member", "member", "member_id"),
        _repeated("primary_key", "booking", "booking", "booking_id"),
        _repeated("primary_key", "item", "item", "item_id"),
        _repeated("primary_key", "shift", "staff", "employee_id"),
        _repeated("primary_key", "order_line",
                  "(SELECT l_orderkey || '/' || l_linenumber AS order_id FROM lineitem)", "order_id")))
    q["audit_unique"] = _sql("member item", _union(
        _repeated("unique:username", "member", "member", "username"),
        _repeated("unique:email", "member", "member", "email"),
        _repeated("unique:item_name", "item", "item", "item_name")))
    q["audit_foreign_keys"] = _sql(f"restaurant rtable staff member item time_slot {_BK} order_line menu command", _union(
        _dangling("rtable", "rtable", "restaurant_id", "restaurant", "restaurant_id"),
        _dangling("booking", "booking", "member_id", "member", "member_id"),
        _dangling("booking", "booking", "restaurant_id", "restaurant", "restaurant_id"),
        _dangling("booking", "booking", "table_id", "rtable", "table_id"),
        _dangling("booking", "booking", "start_time_slot", "time_slot", "slot_id"),
        _dangling("menu", "menu", "restaurant_id", "restaurant", "restaurant_id"),
        _dangling("menu", "menu", "item_id", "item", "item_id"),
        _dangling("order_line", "order_line", "booking_id", "booking", "booking_id"),
        _dangling("order_line", "order_line", "item_id", "item", "item_id"),
        _dangling("shift", "staff", "restaurant_id", "restaurant", "restaurant_id"),
        _dangling("shift", "staff", "first_slot", "time_slot", "slot_id"),
        _dangling("command", "command", "booking_id", "booking", "booking_id"),
        _dangling("command", "command", "member_id", "member", "member_id")))
    q["audit_not_null"] = _sql(_BK, _union(
        _count_rule("not_null", "booking", "booking_method", "booking", "booking_status = 'cancelled'"),
        _count_rule("not_null", "booking_status", "booking_status", "booking", "booking_status IS NULL")))
    methods = "'website', 'walk-in', 'phone call'"
    q["audit_enum_domain"] = _sql(f"staff {_BK}", _union(
        _outside("member", "(SELECT c_mktsegment AS member_status FROM customer)", "member_status",
                 "'just member', 'active', 'cancelled'"),
        _outside("employee", "staff", "role", "'chef', 'server', 'manager'"),
        _outside("booking", "booking", "booking_method", methods),
        _outside("booking_status", "booking", "booking_status",
                 "'scheduled', 'ongoing', 'completed', 'cancelled'")))
    q["audit_type_bounds"] = _sql(f"restaurant member item staff {_BK} order_line price totals", _union(
        _count_rule("bounds", "restaurant", "restaurant_name", "restaurant", "length(restaurant_name) > 100"),
        _count_rule("bounds", "restaurant", "zip_code", "restaurant", "length(restaurant_name) > 10"),
        _count_rule("bounds", "restaurant", "tax", "restaurant", "abs(tax) >= 10"),
        _count_rule("bounds", "employee", "employee_name", "staff", "length(employee_name) > 50"),
        _count_rule("bounds", "member", "username", "member", "length(username) > 50"),
        _count_rule("bounds", "member", "email", "member", "length(email) > 100"),
        _count_rule("bounds", "item", "item_name", "item", "length(item_name) > 255"),
        _count_rule("bounds", "item", "price", "lineitem JOIN part ON p_partkey = l_partkey",
                    "abs(l_extendedprice / l_quantity) >= 1000"),
        _count_rule("bounds", "past_booking", "total_price", "totals", "abs(total_price) >= 100000000"),
        _count_rule("bounds", "past_booking", "total_tax", "totals", "abs(total_tax) >= 100000000"),
        _count_rule("bounds", "past_booking", "total_price_after_tax", "totals",
                    "abs(total_price_after_tax) >= 100000000")))
    q["audit_status_one_to_one"] = _sql(_BK, _union(
        f"{_finding('status_repeated', 'booking_status', 'booking_id', '2')} FROM booking "
        "WHERE booking_status = 'completed'",
        f"{_finding('status_missing', 'booking', 'booking_id', '1')} FROM booking "
        "WHERE booking_status = 'cancelled'"))
    cell_key = "table_id || '/' || strftime(service_date, '%Y-%m-%d') || '/' || slot_id"
    q["audit_double_booking"] = _sql(
        f"{_BK} open_booking held_slot",
        f"{_finding('double_booking', 'booking', cell_key)} FROM held_slot "
        "GROUP BY table_id, service_date, slot_id HAVING count(*) > 1")
    q["audit_slot_overrun"] = _sql(
        _BK, f"{_finding('slot_overrun', 'booking', 'booking_id', '1')} FROM booking "
             "WHERE start_time_slot + booking_duration - 1 > 14")
    q["audit_member_single_open"] = _sql(
        f"{_BK} open_booking", _repeated("several_open_bookings", "booking", "open_booking", "member_id"))
    q["audit_billing_reconciliation"] = _sql(
        f"item {_BK} order_line price", _union(
            f"{_finding('payment_status_wrong', 'billing', 'booking_id', 'bills')} FROM sums "
            "WHERE booking_status = 'ongoing' AND bills > 0",
            f"{_finding('bills_do_not_add_up', 'billing', 'booking_id', 'bills')} FROM sums "
            "WHERE price IS DISTINCT FROM billed"), """
        sums AS (
            SELECT booking_id, booking_status, price, CAST(coalesce(b.bills, 0) AS BIGINT) AS bills, b.billed
            FROM booking LEFT JOIN price USING (booking_id)
                 LEFT JOIN (SELECT l_orderkey AS booking_id, count(*) AS bills,
                                   CAST(sum(price * CAST(l_quantity AS INTEGER)) AS DECIMAL(18,2)) AS billed
                            FROM lineitem JOIN item ON item_id = l_partkey
                            WHERE l_returnflag <> 'R' GROUP BY 1) b USING (booking_id))""")

    # --- streaming
    q["stream_demand_tumbling"] = _sql("command", """
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, requests FROM (
            SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests
            FROM command WHERE command = 'new_booking' GROUP BY 1)
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM command WHERE command = 'new_booking')
              - INTERVAL 10 MINUTE""")
    q["stream_dedupe_commands"] = _sql("command", "SELECT DISTINCT command_id, ts, command, member_id FROM command")
    return q
