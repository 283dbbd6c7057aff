"""Clustering of stored months across their files, so that a filter opens few of them.

A month that is written by many tasks has rows of every category in every file. Here its rows are
ordered along a Z curve of the clustering columns and cut into files by ranges of that
order: each file holds a narrow range of every column. The lowest and highest values of
each file are listed beside the table, and a filter on them names the files to open.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.incremental import CLUSTER_BY, MONTH_COLUMN
from cartwheel.sources.replace import Folders
from cartwheel.sources.versions import VersionedTable

#: Bits of each column's place on the curve.
BITS = 8
#: Bytes of a file.
FILE_BYTES = 128 << 20
_STATS = "_ranges"


def _places(rows: DataFrame, column: str) -> DataFrame:
    """Each value's place among the rows, from 0 to 2^BITS - 1: frequent values get as much
    of the curve as they have rows. One row per value."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("value").asc_nulls_first())
    before = F.sum("n").over(order) - F.col("n")
    return counts.select("value", F.floor(before * (1 << BITS) / F.sum("n").over(Window.partitionBy())).alias(column))


def z_order(rows: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``rows`` with ``z``, the bits of each column's place interleaved, first column first."""
    columns = list(columns)
    placed = rows
    for column in columns:
        at = _places(rows, column).withColumnRenamed(column, f"_at_{column}")
        placed = placed.join(at, F.col(column).eqNullSafe(F.col("value"))).drop("value")

    def bit(column: str, k: int) -> Column:
        return F.shiftright(F.col(f"_at_{column}"), k).bitwiseAND(F.lit(1))

    z = F.lit(0).cast("long")
    for k in range(BITS - 1, -1, -1):
        for column in columns:
            z = F.shiftleft(z, 1).bitwiseOR(bit(column, k))
    return placed.withColumn("z", z).drop(*(f"_at_{c}" for c in columns))


def recluster(table: VersionedTable, months: Iterable[date] | None = None, columns: Iterable[str] = CLUSTER_BY,
              tie: str = "order_id", file_bytes: int = FILE_BYTES) -> list[date]:
    """Write the months that have more than one file anew, in files along the curve; their first days.

    All or the given ``months``. ``tie`` parts rows of equal columns, so that a value of any
    number of rows is spread over files. A month is replaced as one version; if someone else
    writes it meanwhile, theirs stays and this raises. Rows do not change.
    """
    columns, files = list(columns), Folders(table.spark, table.path)
    wanted = None if months is None else {m.isoformat() for m in months}
    done = []
    for name in sorted({part for _, part in table.version().parts}):
        month = name.removeprefix(f"{MONTH_COLUMN}=")
        if wanted is not None and month not in wanted:
            continue
        since = table.version()
        folders = [f"{table.path}/{folder}/{part}" for folder, part in since.parts if part == name]
        sizes = [size for folder in folders for size in files.data_files(folder).values()]
        if len(sizes) < 2:
            continue
        rows = table.read(since.number).where(F.col(MONTH_COLUMN) == F.lit(month).cast("date"))
        n = max(1, -(-sum(sizes) // file_bytes))
        ordered = z_order(rows, columns).repartitionByRange(n, "z", tie).sortWithinPartitions("z", tie).drop("z")
        version = table.replace_partitions(ordered, lambda m, month=month: m == month,
                                           ordered.write.partitionBy(MONTH_COLUMN).parquet, since=since)
        _list_ranges(table, f"{table.path}/{version.parts[-1][0]}/{name}", columns)
        done.append(date.fromisoformat(month))
    return done


def _list_ranges(table: VersionedTable, folder: str, columns: list[str]) -> None:
    """Store the lowest and highest values of each file of a folder, beside the versions.

    NULLs do not count, as no value equals them; a file of NULLs alone has no bounds.
    """
    rows = table.spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        *(b for c in columns for b in (F.min(c).alias(f"{c}_low"), F.max(c).alias(f"{c}_high"))))
    name = folder.removeprefix(f"{table.path}/").replace("/", "+")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{table.path}/{_STATS}/{name}")


def files_for(table: VersionedTable, values: Mapping[str, str]) -> list[str]:
    """The files of the latest version that may hold rows with these values of clustering columns."""
    files, found = Folders(table.spark, table.path), []
    for folder, part in table.version().parts:
        stats = f"{table.path}/{_STATS}/{f'{folder}/{part}'.replace('/', '+')}"
        if not files.exists(stats):
            found += files.data_files(f"{table.path}/{folder}/{part}")
            continue
        ranges = table.spark.read.parquet(stats)
        for column, value in values.items():
            ranges = ranges.where(F.lit(value).between(F.col(f"{column}_low"), F.col(f"{column}_high")))
        found += [r["file"] for r in ranges.select("file").collect()]
    return found


def read_where(table: VersionedTable, **values: str) -> DataFrame:
    """Rows of the latest version with these values of clustering columns; other files are not opened."""
    version, chosen = table.version(), files_for(table, values)
    match = F.lit(True)
    for column, value in values.items():
        match = match & (F.col(column) == F.lit(value))
    if not chosen:
        return table.spark.createDataFrame([], version.schema)
    rows = table.spark.read.schema(version.schema).option("basePath", table.path).parquet(*chosen)
    return rows.select(*version.schema.names).where(match)
