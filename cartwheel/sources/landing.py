"""Landing drops, gating sources, loading tables and write dispositions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import CSV_TABLES
from cartwheel.session import in_parallel
from cartwheel.sources.replace import Folders, recover, replace_table
from cartwheel.sources.versions import VersionedTable
from cartwheel.sources.files import drop_path, read_drop, write_csv

STATUS_SCHEMA = "`table` string, status string, `rows` bigint, reason string"


class LoadFailed(RuntimeError):
    """At least one table of a load failed; ``status`` has a row for every table."""

    def __init__(self, status: DataFrame, failed: list[str]):
        super().__init__(f"load failed for: {', '.join(failed)}")
        self.status = status


def path_exists(spark: SparkSession, path: str) -> bool:
    return Folders(spark, path).exists(path)


def bytes_at(spark: SparkSession, path: str) -> int:
    return Folders(spark, path).bytes_at(path)


def validate_source(spark: SparkSession, path: str) -> None:
    """A missing or empty source is an error before anything is loaded."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"source not found: {path}")
    if bytes_at(spark, path) == 0:
        raise ValueError(f"source is empty: {path}")


def land(df: DataFrame, base: str, folder: str, load_date: date | str,
         force: bool = False) -> str:
    """Write one drop as CSV unless it is there already; ``"success"`` or ``"skipped"``.

    Only a finished drop counts as there: one that an interrupted job left behind
    has no success marker and is written again.
    """
    path = drop_path(base, folder, load_date)
    if not force and path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return "skipped"
    write_csv(df, path, mode="overwrite")
    return "success"


def write_table(df: DataFrame, target: str | VersionedTable, disposition: str = "truncate") -> None:
    """``truncate`` replaces, ``append`` adds, ``empty`` writes only to an empty table.

    A write that fails leaves the table as it was, and a swap that stopped half way is undone
    before any of them. In a versioned table each write is one version.
    """
    if disposition not in ("truncate", "append", "empty"):
        raise ValueError(f"unknown write disposition {disposition!r}")
    if isinstance(target, VersionedTable):
        {"truncate": target.replace, "append": target.append, "empty": target.fill}[disposition](df)
        return
    spark = df.sparkSession
    if disposition == "truncate":
        replace_table(spark, target, df.write.parquet)
        return
    recover(Folders(spark, target), target)
    if disposition == "empty":
        if path_exists(spark, target) and not spark.read.schema(df.schema).parquet(target).isEmpty():
            raise ValueError(f"table is not empty: {target}")
    df.write.mode("append").parquet(target)


def write_counted(df: DataFrame, target: str | VersionedTable, disposition: str = "truncate") -> int:
    """Write and count in the same pass over the rows."""
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), target, disposition)
    return int(seen.get["rows"])


def write_if_nonempty(df: DataFrame, target: str | VersionedTable) -> bool:
    """Replace the table, but keep the old one when the batch has no rows or fails."""
    if df.isEmpty():
        return False
    write_table(df, target)
    return True


def load_all(spark: SparkSession, base: str, target: str, load_date: date | str,
             tables: dict[str, T.StructType] | None = None,
             strict: bool = True) -> DataFrame:
    """Load the CSV drops of one date into parquet tables, one status row per table.

    A drop without rows, as one of a header alone, is an error. A table that fails keeps
    its old rows and does not stop the others. With ``strict`` the load raises
    :class:`LoadFailed` at the end if any did.
    """
    def load_one(name: str, schema: T.StructType) -> int:
        validate_source(spark, drop_path(base, name, load_date))
        # Any table may hold a line break inside quotes.
        drop = read_drop(spark, base, name, load_date, schema, free_text=True)
        seen = Observation()

        def write(folder: str) -> None:
            drop.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
            if not seen.get["rows"]:
                raise ValueError(f"source has no rows: {drop_path(base, name, load_date)}")

        replace_table(spark, f"{target}/{name}", write)
        return int(seen.get["rows"])

    return _run_each(spark, tables or CSV_TABLES, load_one, strict)


def land_all(frames: dict[str, DataFrame], base: str, load_date: date | str,
             force: bool = False, strict: bool = True) -> DataFrame:
    """Land several tables, one status row per table."""
    spark = next(iter(frames.values())).sparkSession
    return _run_each(spark, frames,
                     lambda name, df: land(df, base, name, load_date, force), strict)


def _run_each(spark: SparkSession, items: dict, step: Callable, strict: bool) -> DataFrame:
    outcomes = in_parallel(spark, {name: lambda name=name, item=item: step(name, item)
                                   for name, item in items.items()})
    rows = []
    for name, outcome in outcomes.items():
        if isinstance(outcome, BaseException):
            rows.append((name, "error", None, str(outcome)))
        elif isinstance(outcome, int):
            rows.append((name, "success", outcome, None))
        else:
            rows.append((name, outcome, None, None))
    status = spark.createDataFrame(rows, STATUS_SCHEMA)
    failed = [r[0] for r in rows if r[1] == "error"]
    if failed and strict:
        raise LoadFailed(status, failed)
    return status
