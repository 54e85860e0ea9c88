"""Tables whose column defaults the catalogue declares, and inserts that name their columns.

A table is created with ``DEFAULT`` clauses; an insert lists the columns it brings and Spark
fills the others. A NULL that is given stays NULL. Columns that default to the current time
take the event time instead when the insert names one, so that a replay of old events is
dated as they were and can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatledger.schemas import DEFAULTS, NOW_DEFAULTS, TABLES
from seatledger.session import scratch_path


def default_clause(table: str, column: str) -> str:
    """The column's ``DEFAULT`` clause; columns without a declared default start as NULL."""
    if column in NOW_DEFAULTS.get(table, ()):
        return " DEFAULT current_timestamp()"
    value = DEFAULTS.get(table, {}).get(column)
    if value is None:
        return ""
    text = str(value).replace("'", "''")
    return f" DEFAULT CAST('{text}' AS {TABLES[table][column].dataType.simpleString()})"


def create_table(spark: SparkSession, table: str, path: str, name: str | None = None) -> str:
    """Create the model's ``table`` as ``name`` over parquet files at ``path``; returns the name.

    The catalogue keeps the definition; dropping the table leaves the files.
    """
    name = name or table
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{default_clause(table, f.name)}" for f in TABLES[table].fields
    )
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")
    return name


def insert_rows(rows: DataFrame, table: str, name: str | None = None, event_time: Column | str | None = None) -> None:
    """Append ``rows`` to the table, naming only the columns they have.

    Columns the table doesn't know are an error. ``event_time`` dates the columns whose
    default is the current time, unless ``rows`` brings them.
    """
    unknown = set(rows.columns) - set(TABLES[table].names)
    given = rows
    if event_time is not None:
        at = F.col(event_time) if isinstance(event_time, str) else event_time
        unknown -= {event_time} if isinstance(event_time, str) else set()
        dated = {c: at.cast("timestamp") for c in NOW_DEFAULTS.get(table, ()) if c not in rows.columns}
        given = rows.withColumns(dated) if dated else rows
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    listed = [c for c in given.columns if c in TABLES[table].names]
    target = f"{name or table} ({', '.join(f'`{c}`' for c in listed)})"
    rows.sparkSession.sql(f"INSERT INTO {target} SELECT * FROM {{given}}", given=given.select(*listed))


def inserted(rows: DataFrame, table: str, event_time: Column | str | None = None) -> DataFrame:
    """``rows`` as the stored rows of a fresh table: written through the catalogue and read back.

    Runs when called. The files lie in the shared folder; the definition goes again.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, f"insert-{table}")
    name = create_table(spark, table, path, path.rsplit("/", 1)[1].replace("-", "_"))
    try:
        insert_rows(rows, table, name, event_time)
        return spark.read.schema(TABLES[table]).parquet(path)
    finally:
        spark.sql(f"DROP TABLE {name}")
