"""Declared rules checked over whole tables.

Each audit returns the violations as (rule, table_name, key, n): the offending key as
text and how many rows are involved. Key rules are rows of a rule table and share one
aggregate; column rules are metrics of a job that runs anyway.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seatledger import schemas
from seatledger.functions.expressions import SLOTS_PER_DAY, from_cents, slot_fits, to_cents
from seatledger.operators.changes import booking_cells

OPEN = ("scheduled", "ongoing")


def _finding(rule: str, table: str, key: Column | str, n: Column | str) -> list[Column]:
    key = F.col(key) if isinstance(key, str) else key
    n = F.col(n) if isinstance(n, str) else n
    return [
        F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
        key.cast("string").alias("key"), n.cast("bigint").alias("n"),
    ]


def stack(findings: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def _count() -> Column:
    return F.count(F.lit(1))


def duplicates(df: DataFrame, table: str, key: str, rule: str, nulls_exempt: bool = True) -> DataFrame:
    rows = df.where(F.col(key).isNotNull()) if nulls_exempt else df
    broken = F.col("n") > 1 if nulls_exempt else (F.col("n") > 1) | F.col(key).isNull()
    return rows.groupBy(key).agg(_count().alias("n")).where(broken).select(
        *_finding(rule, table, key, "n")
    )


# --- rule tables ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A rule on one column; a reference also names the ``parent`` column it must be found in."""

    name: str
    table: str
    column: str
    parent: tuple[str, str] | None = None
    null_breaks: bool = False


def covered(
    rules: Iterable[Rule], tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> list[Rule]:
    """The rules to check; a declared rule whose column isn't there is an error, not a pass.

    ``only`` restricts the audit to some tables. ``leave_out`` names, as ``table`` or
    ``table.column``, what is knowingly not checked.
    """
    only, leave_out = None if only is None else set(only), set(leave_out)
    chosen = []
    for rule in rules:
        own = (rule.table, rule.column)
        if only is not None and rule.table not in only or leave_out & {rule.table, ".".join(own)}:
            continue
        for table, column in (own, *([rule.parent] if rule.parent else ())):
            if table not in tables or column not in tables[table].columns:
                raise ValueError(f"{rule.name} of {'.'.join(own)} needs {table}.{column}, which is not there")
        chosen.append(rule)
    return chosen


def key_findings(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """All broken key rules from one scan of each table and one aggregate.

    A row becomes one (rule, key, side) for each rule its table takes part in, on the side
    that must be unique or must have a parent, or on the parent's side. Counts are combined
    before the shuffle, so a hot key costs one record for each task.
    """
    sides: dict[str, list[Column]] = {}
    for number, rule in enumerate(rules):
        ends = [(rule.table, rule.column, 1), *([(*rule.parent, 0)] if rule.parent else ())]
        for table, column, own in ends:
            sides.setdefault(table, []).append(F.struct(
                F.lit(number).alias("rule"), F.col(column).cast("string").alias("key"), F.lit(own).alias("own")
            ))
    if not rules:
        raise ValueError("no rules to check")
    nullable = [n for n, rule in enumerate(rules) if rule.null_breaks]
    counted = F.col("key").isNotNull() | F.col("rule").isin(nullable) if nullable else F.col("key").isNotNull()
    rows = stack(tables[t].select(F.explode(F.array(*own)).alias("r")).select("r.*") for t, own in sides.items())
    both = rows.where(counted).groupBy("rule", "key").agg(F.sum("own").alias("n"), F.sum(1 - F.col("own")).alias("parents"))
    references = [n for n, rule in enumerate(rules) if rule.parent]
    dangling = F.col("rule").isin(references) if references else F.lit(False)
    broken = F.when(dangling, (F.col("n") > 0) & (F.col("parents") == 0)).otherwise((F.col("n") > 1) | F.col("key").isNull())
    return both.where(broken).select(
        *(F.element_at(F.array(*(F.lit(text) for text in texts)), F.col("rule") + 1).alias(name)
          for name, texts in (("rule", [r.name for r in rules]), ("table_name", [r.table for r in rules]))),
        "key", F.col("n").cast("bigint").alias("n"),
    )


def primary_key_rules() -> list[Rule]:
    return [Rule("primary_key", t, key, null_breaks=True) for t, key in schemas.PRIMARY_KEYS.items()]


def unique_rules() -> list[Rule]:
    return [Rule(f"unique:{c}", t, c) for t, c in schemas.UNIQUE_COLUMNS]


def reference_rules(foreign_keys: Iterable[schemas.ForeignKey] = schemas.FOREIGN_KEYS) -> list[Rule]:
    return [Rule(f"foreign_key:{fk.column}", fk.child, fk.column, (fk.parent, fk.parent_key)) for fk in foreign_keys]


def audit_primary_keys(
    tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> DataFrame:
    """Primary keys are unique and present."""
    return key_findings(tables, covered(primary_key_rules(), tables, only, leave_out))


def audit_unique(
    tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> DataFrame:
    """UNIQUE columns; NULLs are exempt."""
    return key_findings(tables, covered(unique_rules(), tables, only, leave_out))


def audit_foreign_keys(
    tables: Mapping[str, DataFrame], foreign_keys: Iterable[schemas.ForeignKey] = schemas.FOREIGN_KEYS,
    only: Iterable[str] | None = None, leave_out: Iterable[str] = (),
) -> DataFrame:
    """Every non-NULL reference has its parent."""
    return key_findings(tables, covered(reference_rules(foreign_keys), tables, only, leave_out))


def audit_keys(
    tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> DataFrame:
    """C1, C2 and C3 together, still with one scan of each table."""
    rules = [*primary_key_rules(), *unique_rules(), *reference_rules()]
    return key_findings(tables, covered(rules, tables, only, leave_out))


# --- column rules as metrics of a job that runs anyway --------------------------------------


def not_null_tests() -> dict[Rule, Column]:
    return {Rule(f"not_null:{c}", t, c): F.col(c).isNull() for t, c in schemas.NOT_NULL_COLUMNS}


def bounds_tests() -> dict[Rule, Column]:
    """Texts longer than declared and amounts outside their declared precision."""
    tests = {Rule(f"bounds:{c}", t, c): F.length(c) > n for (t, c), n in schemas.TEXT_LIMITS.items()}
    return tests | {
        Rule(f"bounds:{c}", t, c): F.abs(F.col(c)) >= F.lit(10 ** (p - s)) for (t, c), (p, s) in schemas.DECIMAL_LIMITS.items()
    }


class ColumnWatch:
    """Counts broken column rules while a table is loaded or written.

    ``over`` attaches the counts to a frame; they are collected as metrics of whatever job
    then reads all of it, such as its write, and need no scan of their own. ``findings``
    returns them afterwards. A frame that no job has run through makes ``findings`` wait.
    """

    def __init__(self, tests: Mapping[Rule, Column]):
        self._tests = dict(tests)
        self._watched: list[tuple[list[Rule], Observation]] = []

    def over(self, df: DataFrame, table: str) -> DataFrame:
        rules = [r for r in self._tests if r.table == table and r.column in df.columns]
        if not rules:
            return df
        seen = Observation(f"watch-{table}-{len(self._watched)}")
        self._watched.append((rules, seen))
        return df.observe(seen, *(F.count_if(self._tests[r]).alias(f"m{k}") for k, r in enumerate(rules)))

    def findings(self, spark: SparkSession) -> DataFrame:
        rows = [
            (r.name, r.table, r.column, int(seen.get[f"m{k}"]))
            for rules, seen in self._watched for k, r in enumerate(rules)
        ]
        return spark.createDataFrame([r for r in rows if r[3]], "rule string, table_name string, key string, n bigint")


def _watched_pass(
    tables: Mapping[str, DataFrame], tests: Mapping[Rule, Column], only: Iterable[str] | None, leave_out: Iterable[str]
) -> DataFrame:
    chosen = covered(tests, tables, only, leave_out)
    watch = ColumnWatch({r: tests[r] for r in chosen})
    names = dict.fromkeys(r.table for r in chosen)
    if not names:
        raise ValueError("no rules to check")
    passing = stack(watch.over(tables[t], t).select(F.lit(1).alias("row")) for t in names)
    passing.write.format("noop").mode("overwrite").save()
    return watch.findings(passing.sparkSession)


def audit_not_null(
    tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> DataFrame:
    """C4: required columns are present; one job over all tables, which runs when this is called."""
    return _watched_pass(tables, not_null_tests(), only, leave_out)


def audit_type_bounds(
    tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> DataFrame:
    """Declared lengths and precisions hold; one job over all tables, which runs when this is called."""
    return _watched_pass(tables, bounds_tests(), only, leave_out)


def audit_enum_domain(
    tables: Mapping[str, DataFrame], only: Iterable[str] | None = None, leave_out: Iterable[str] = ()
) -> DataFrame:
    """Values outside their domain, compared without regard to case.

    Each table is scanned once, and only values outside reach the shuffle.
    """
    allowed = {Rule(f"domain:{c}", t, c): values for (t, c), values in schemas.DOMAINS.items()}
    rules = covered(allowed, tables, only, leave_out)
    outside: dict[str, list[Column]] = {}
    for rule in rules:
        own = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.table).alias("table_name"), F.col(rule.column).alias("key"))
        wrong = F.col(rule.column).isNotNull() & ~F.lower(F.trim(F.col(rule.column))).isin(*allowed[rule])
        outside.setdefault(rule.table, []).append(F.when(wrong, own))
    rows = stack(tables[t].select(F.explode(F.array_compact(F.array(*own))).alias("r")).select("r.*") for t, own in outside.items())
    return rows.groupBy("rule", "table_name", "key").agg(_count().cast("bigint").alias("n"))


# --- invariants ------------------------------------------------------------------------------


def audit_status_one_to_one(bookings: DataFrame, booking_status: DataFrame) -> DataFrame:
    """Every booking has exactly one status row."""
    return stack([
        duplicates(booking_status, "booking_status", "booking_id", "status_repeated"),
        bookings.join(booking_status.select("booking_id"), "booking_id", "left_anti").select(
            *_finding("status_missing", "booking", "booking_id", F.lit(1))
        ),
    ])


def audit_double_booking(booking_state: DataFrame) -> DataFrame:
    """Table slots held by more than one open booking on a date, slots past closing too."""
    held = booking_state.where(F.col("booking_status").isin(*OPEN))
    cells = booking_cells(held).groupBy("table_id", "service_date", "slot_id").agg(_count().alias("n"))
    key = F.concat_ws("/", "table_id", F.date_format("service_date", "yyyy-MM-dd"), "slot_id")
    return cells.where("n > 1").select(*_finding("double_booking", "booking", key, "n"))


def audit_slot_overrun(bookings: DataFrame, slots: int = SLOTS_PER_DAY) -> DataFrame:
    """Intervals that do not fit opening hours."""
    fits = slot_fits(F.col("start_time_slot"), F.col("booking_duration"), slots)
    return bookings.where(~fits).select(*_finding("slot_overrun", "booking", "booking_id", F.lit(1)))


def audit_member_single_open(booking_state: DataFrame) -> DataFrame:
    """Members with more than one open booking."""
    held = booking_state.where(F.col("booking_status").isin(*OPEN))
    return duplicates(held, "booking", "member_id", "several_open_bookings")


def audit_billing_reconciliation(
    booking_state: DataFrame, billing: DataFrame, prices: DataFrame
) -> DataFrame:
    """C11: bills add up to the booking price, and are paid exactly when the booking is completed."""
    billed = billing.groupBy("booking_id").agg(
        from_cents(F.sum(to_cents(F.col("total_amount")))).alias("billed"),
        F.count_if(F.col("payment_status") == "paid").alias("paid"),
        _count().alias("bills"),
    )
    joined = prices.join(billed, "booking_id", "full").join(
        booking_state.select("booking_id", "booking_status"), "booking_id", "left"
    )
    done = F.col("booking_status").eqNullSafe("completed")
    wrong_sum = ~F.col("price").eqNullSafe(F.col("billed"))
    wrong_status = F.when(done, F.col("paid") < F.col("bills")).otherwise(F.col("paid") > 0)
    rules = F.filter(
        F.array(
            F.when(wrong_sum, F.lit("bills_do_not_add_up")),
            F.when(wrong_status, F.lit("payment_status_wrong")),
        ),
        lambda r: r.isNotNull(),
    )
    return joined.select("booking_id", F.explode(rules).alias("rule"), F.coalesce("bills", F.lit(0)).alias("n")).select(
        "rule", F.lit("billing").alias("table_name"), F.col("booking_id").cast("string").alias("key"),
        F.col("n").cast("bigint").alias("n"),
    )
