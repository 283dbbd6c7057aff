"""Exact quantile buckets over a whole table without sorting it in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.session import keep

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


@dataclass(frozen=True)
class Ntile:
    """Buckets ``1..buckets`` of equal size in the order of a column."""

    name: str
    order: str
    buckets: int = 4
    descending: bool = False


def global_ntile(df: DataFrame, tie: str, *specs: Ntile) -> DataFrame:
    """Add one ``ntile`` column per spec, equal to ``ntile(n) over (order by ..., tie)``.

    A window without a partition would sort every row in a single task. Here only
    the order columns and the unique ``tie`` are range-partitioned and sorted, all
    specs in one shuffle; the last row of each bucket is looked up by its position,
    and the table itself is scored by comparing with those few rows. NULLs come
    first ascending, last descending. ``df`` is read twice: pass a stored table.
    """
    scored = df
    for spec, ends in zip(specs, _bucket_ends(df, tie, specs)):
        scored = scored.withColumn(spec.name, _bucket(spec, tie, ends))
    return scored


def _bucket_ends(df: DataFrame, tie: str, specs: tuple[Ntile, ...]) -> list[list]:
    """Per spec the last row of every bucket but the final one, as (order, tie) pairs.

    A row is listed once per spec, with the order column of that spec and NULL for
    the others, so one sort by spec and then all order columns sorts each of them.
    """
    keys = [f"_key{i}" for i in range(len(specs))]

    def entry(i: int) -> Column:
        own = [
            (F.col(spec.order) if j == i else F.lit(None).cast(df.schema[spec.order].dataType))
            .alias(keys[j]) for j, spec in enumerate(specs)
        ]
        return F.struct(F.lit(i).alias("_spec"), *own, F.col(tie).alias("_tie"))

    order = [F.col("_spec"), *[
        F.col(key).desc_nulls_last() if spec.descending else F.col(key).asc_nulls_first()
        for key, spec in zip(keys, specs)
    ], F.col("_tie")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = keep(
        df.select(F.inline(F.array(*[entry(i) for i in range(len(specs))])))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranked",
    )
    # at most one row per partition and spec
    sizes = (
        ranked.groupBy(F.shiftright("_slot", _ROW_BITS).alias("part"), "_spec")
        .agg(F.count(F.lit(1)).alias("rows")).orderBy("part", "_spec").collect()
    )
    runs: list[list[tuple[int, int]]] = [[] for _ in specs]  # per spec: first slot, rows
    filled: dict[int, int] = {}
    for s in sizes:
        before = filled.get(s["part"], 0)
        runs[s["_spec"]].append(((s["part"] << _ROW_BITS) + before, s["rows"]))
        filled[s["part"]] = before + s["rows"]

    slots = [
        [_slot_at(run, position)
         for position in _end_positions(sum(rows for _, rows in run), spec.buckets)]
        for run, spec in zip(runs, specs)
    ]
    wanted = [slot for some in slots for slot in some]
    if not wanted:
        return [[] for _ in specs]
    found = {r["_slot"]: (r[keys[r["_spec"]]], r["_tie"])
             for r in ranked.where(F.col("_slot").isin(wanted)).collect()}
    return [[found[slot] for slot in some] for some in slots]


def _end_positions(total: int, buckets: int) -> list[int]:
    """1-based positions of the last row of each bucket that has another one behind it.

    The first ``total mod buckets`` buckets hold one row more than the rest.
    """
    base, larger = divmod(total, buckets)
    ends = [k * base + min(k, larger) for k in range(1, buckets)]
    return [end for end in ends if 0 < end < total]


def _slot_at(runs: list[tuple[int, int]], position: int) -> int:
    """The slot of a 1-based position in stretches of consecutive slots."""
    for first, rows in runs:
        if position <= rows:
            return first + position - 1
        position -= rows
    raise ValueError("position is outside the table")


def _bucket(spec: Ntile, tie: str, ends: list) -> Column:
    """1 plus the number of bucket ends that a row comes after."""
    key = F.col(spec.order)
    bucket = F.lit(1)
    for end_key, end_tie in ends:
        behind = _before(key, end_key) if spec.descending else _after(key, end_key)
        after = behind | (key.eqNullSafe(F.lit(end_key)) & _after(F.col(tie), end_tie))
        bucket = bucket + after.cast("int")
    return bucket


def _after(column: Column, value) -> Column:
    """Greater than the value, with NULL as the smallest one."""
    if value is None:
        return column.isNotNull()
    return F.coalesce(column > F.lit(value), F.lit(False))


def _before(column: Column, value) -> Column:
    """Less than the value, with NULL as the smallest one."""
    if value is None:
        return F.lit(False)
    return F.coalesce(column < F.lit(value), F.lit(True))


def global_place(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``place``, each row's number from 0 in a global order, without one task that sees all.

    The rows are range-partitioned and sorted, and stored; the sizes of the parts, one row each, give
    every part its first number. Rows that are equal in ``order`` come in any order.
    """
    ordered = keep(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()),
        "ordered-rows")
    sizes = ordered.groupBy("_task").agg(F.count(F.lit(1)).alias("n"), F.min("_row").alias("_first"))
    before = F.sum("n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sizes.select("_task", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return ordered.join(F.broadcast(shifts), "_task").withColumn(
        "place", F.col("_row") - F.col("_first") + F.col("_before")).drop("_task", "_row", "_first", "_before")
