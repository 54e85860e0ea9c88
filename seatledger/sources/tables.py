"""Reading and writing booking tables with explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger import schemas
from seatledger.operators.changes import with_defaults

# Never loaded, whatever the source contains.
CREDENTIALS = frozenset({"password", "password_hash"})


def normalise(df: DataFrame, table: str) -> DataFrame:
    """Lower-case domain columns: the model compares them without regard to case."""
    domain = {
        c: F.lower(F.trim(F.col(c))) for t, c in schemas.DOMAINS if t == table and c in df.columns
    }
    return df.withColumns(domain) if domain else df


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet", **options) -> DataFrame:
    """Scan one table with its declared schema; nothing is inferred."""
    reader = spark.read.format(fmt).schema(schemas.TABLES[table]).options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
    df = reader.load(path)
    df = df.drop(*[c for c in df.columns if c in CREDENTIALS])
    return with_defaults(normalise(df, table), schemas.DEFAULTS.get(table, {}))


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def reload_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a table; with ``partition_by`` only the partitions present in ``df``."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Store a fact table bucketed and sorted by its join key.

    Bookings, their status, order lines and bills all join on ``booking_id``; equal bucket
    counts make those joins shuffle-free.
    """
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


class Database:
    """The booking tables as attributes, each a lazy DataFrame."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = dict(tables)

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name in tables:
            return tables[name]
        raise AttributeError(name)

    @classmethod
    def load(cls, spark: SparkSession, root: str, fmt: str = "parquet", tables=None, **options) -> Database:
        """Every table below ``root``, one folder or file pattern per table name."""
        names = tables or [t for t in schemas.TABLES if t != "command"]
        return cls({t: read_table(spark, f"{root.rstrip('/')}/{t}", t, fmt, **options) for t in names})

    def tables(self) -> dict[str, DataFrame]:
        return dict(self._tables)

    def replace(self, **tables: DataFrame) -> Database:
        """A database with some tables exchanged."""
        return Database({**self._tables, **tables})

    @cached_property
    def booking_state(self) -> DataFrame:
        """Bookings with their status row, NULL where it is missing."""
        return self.booking.join(self.booking_status, "booking_id", "left")

    # A source that derives these columns overrides the filters below with conditions on its
    # raw columns, which reach the scan where a derived value would not.

    def commands_in(self, *kinds: str) -> DataFrame:
        return self.command.where(F.col("command").isin(*kinds))

    def bookings_in(self, *statuses: str) -> DataFrame:
        return self.booking_state.where(F.col("booking_status").isin(*statuses))

    def members_in(self, status: str) -> DataFrame:
        return self.member.where(F.col("member_status") == status)

    def members_owing(self, above) -> DataFrame:
        return self.member.where(F.col("cancellation_penalty") > above)
