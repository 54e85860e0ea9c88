"""Order-dependent building blocks that stay distributed under skew.

``row_number() over (order by ...)`` moves every row into one task, and
``over (partition by hot_key order by ...)`` does the same for a hot key. These
operators range-partition on the full order instead, so a hot key spans many
partitions, and carry one small record per partition across the seams.

The range bounds come from sampling and differ between two executions of the
same plan, so everything that is read twice is written first, as Parquet or, where the
reader needs rows in their sorted partitions, by ``checkpoint()``: a lost executor then
re-reads the same partitions instead of drawing new bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatledger.session import checkpoint_root, stored

SEGMENT = "segment_id"
POSITION = "position"


def ordered_segments(
    df: DataFrame, order: Sequence[str], partitions: int | None = None, break_ties: bool = False
) -> DataFrame:
    """Sort globally by ``order``; add the range partition and the position in the sort.

    ``position`` grows by one per row inside a segment. ``break_ties`` spreads rows that
    agree on the whole order over several partitions, for inputs with many exact copies.
    """
    checkpoint_root(df.sparkSession)
    keys = list(order)
    if break_ties:
        df = df.withColumn("_arrival", F.monotonically_increasing_id())
        keys.append("_arrival")
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return (
        spread.sortWithinPartitions(*keys)
        .drop("_arrival")
        .withColumn(SEGMENT, F.spark_partition_id())
        .withColumn(POSITION, F.monotonically_increasing_id())
        .checkpoint()
    )


def columnar_segments(
    df: DataFrame, order: Sequence[str], partitions: int | None = None, break_ties: bool = False,
    numbered: Sequence[str] | None = None,
) -> DataFrame:
    """Like :func:`ordered_segments`, stored as Parquet: readers take the columns they need.

    The order is in ``segment_id`` and ``position`` alone; a reader may meet the rows in
    any. ``numbered`` adds ``_local``, the number of a row among those of the same keys
    (leading columns of ``order``) in its segment, counted while the sorted rows pass by.
    """
    keys = list(order)
    if break_ties:
        df = df.withColumn("_arrival", F.monotonically_increasing_id())
        keys.append("_arrival")
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    spread = spread.sortWithinPartitions(*keys).drop("_arrival")
    if numbered:
        spread = spread.mapInArrow(_counted(list(numbered)), T.StructType([*spread.schema.fields, T.StructField("_local", T.LongType())]))
    placed = spread.withColumn(SEGMENT, F.spark_partition_id()).withColumn(POSITION, F.monotonically_increasing_id())
    return stored(placed, "segments")


def _counted(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def changes(column: pa.Array, before: pa.Array) -> np.ndarray:
        """Where a value isn't the one before it; two nulls are the same."""
        earlier = pa.concat_arrays([before, column.slice(0, len(column) - 1)])
        unlike = pc.fill_null(pc.not_equal(column, earlier), False).to_numpy(zero_copy_only=False)
        return unlike | (column.is_null().to_numpy(zero_copy_only=False) != earlier.is_null().to_numpy(zero_copy_only=False))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            fresh = np.zeros(batch.num_rows, bool)
            for k, column in enumerate(columns):
                fresh |= changes(column, column.slice(0, 1) if last is None else last[k])
            rows = np.arange(batch.num_rows)
            starts = np.maximum.accumulate(np.where(fresh, rows, 0))
            # Rows before the first change go on counting where the last batch ended.
            local = rows - starts + 1 + np.where(np.logical_or.accumulate(fresh), 0, held)
            last, held = [c.slice(len(c) - 1, 1) for c in columns], int(local[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local)], names=[*batch.schema.names, "_local"])

    return count


def dense_keys(
    df: DataFrame, order: Sequence[str], name: str, start: int = 1, partitions: int | None = None
) -> DataFrame:
    """Consecutive keys ``start, start+1, ...`` in the given order, without gaps.

    One range shuffle of the data, which runs and is stored when this is called; the
    manifest of offsets has one row per partition, and a query on the result reads only the
    columns it asks for.
    """
    ranged = columnar_segments(df, order, partitions, break_ties=True)
    sizes = ranged.groupBy(SEGMENT).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(POSITION).alias("_first")
    )
    # One row per partition, so the unpartitioned window is over metadata only.
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        SEGMENT, (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return (
        ranged.join(F.broadcast(offsets), SEGMENT)
        .withColumn(name, F.col(POSITION) + F.col("_shift") + start)
        .drop(SEGMENT, POSITION, "_shift")
    )


def row_number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, partitions: int | None = None
) -> DataFrame:
    """``row_number`` per key, safe when one key holds a large share of the rows.

    One range shuffle: rows are numbered inside (key, segment) as the sorted rows are
    stored. A hot key's rows lie in several segments and have to add the rows of the
    earlier ones. Only keys at a segment's borders can do that, at most two per segment,
    which bounds the broadcasts. Runs when it is called.
    """
    ranged = columnar_segments(df, [*keys, *order], partitions, numbered=keys)
    marks = [f"_k{i}" for i in range(len(keys))]
    key = F.struct(*(F.col(k).alias(m) for k, m in zip(keys, marks)))
    ends = ranged.groupBy(SEGMENT).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    border = ends.select(F.explode(F.array("low", "high")).alias("k")).select("k.*").distinct()
    same = [F.col(k).eqNullSafe(F.col(m)) for k, m in zip(keys, marks)]
    part = F.col(SEGMENT).alias("_part")
    crossing = ranged.join(F.broadcast(border), same).groupBy(*marks, part).agg(F.max("_local").alias("_rows"))
    earlier = Window.partitionBy(*marks).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = crossing.withColumn("_offset", F.sum("_rows").over(earlier)).where("_offset > 0").drop("_rows")
    return (
        ranged.join(F.broadcast(offsets), [*same, F.col(SEGMENT) == F.col("_part")], "left")
        .withColumn(name, F.col("_local") + F.coalesce(F.col("_offset"), F.lit(0)))
        .select(*df.columns, name)
    )
