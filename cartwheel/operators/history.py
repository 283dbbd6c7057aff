"""Slowly changing history (type 2): incremental snapshot, one-pass rebuild, time travel.

A history holds the tracked columns plus ``dbt_scd_id``, ``dbt_updated_at``,
``dbt_valid_from`` and ``dbt_valid_to``; the open version of a key has no end.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import differs, version_id
from cartwheel.session import keep
from cartwheel.sources.replace import Folders, replace_table

META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
RUN, OPEN_FLAG = "run", "is_open"  # partitions of a stored history
MERGED = "_merged"
#: Runs, or folders of a level, that are merged into one.
FAN = 16


class DuplicateKey(ValueError):
    """A run holds a key twice, or a NULL key."""


@dataclass(frozen=True)
class Snapshot:
    """What a history tracks. Keys, check columns and carried columns."""

    name: str
    key: str
    check_cols: tuple[str, ...]
    columns: tuple[str, ...]


SNAP_PRODUCTS = Snapshot(
    "snap_products", "product_id", ("price_ars", "status", "category_id"),
    ("product_id", "category_id", "category_name", "product_name", "status", "price_ars",
     "currency", "ingested_at"),
)
SNAP_SELLERS = Snapshot("snap_sellers", "seller_id", ("city", "state"),
                        ("seller_id", "city", "state"))


def assert_unique_key(df: DataFrame, key: str) -> None:
    """Refuse a run whose keys are NULL or repeated. Counted before the shuffle."""
    bad = (df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
             .where((F.col("rows") > 1) | F.col(key).isNull()).limit(5).collect())
    if bad:
        raise DuplicateKey(f"{key} is not unique, for example: {[r[key] for r in bad]}")


def empty_history(current: DataFrame) -> DataFrame:
    """A history with no rows for the columns of ``current``."""
    return current.limit(0).select(
        "*", F.lit(None).cast("string").alias("dbt_scd_id"),
        *[F.lit(None).cast("timestamp").alias(c) for c in META[1:]],
    )


def scd2_apply(history: DataFrame, current: DataFrame, key: str, check_cols: list[str],
               run_ts: datetime, invalidate_hard_deletes: bool = True) -> DataFrame:
    """The history after one more run; closed versions pass through untouched."""
    is_open = F.col("dbt_valid_to").isNull()
    merged = merge_run(history.where(is_open), current, key, check_cols, run_ts,
                       invalidate_hard_deletes)
    return history.where(~is_open).select(*merged.columns).unionByName(merged)


def merge_run(open_versions: DataFrame, current: DataFrame, key: str, check_cols: list[str],
              run_ts: datetime, invalidate_hard_deletes: bool = True) -> DataFrame:
    """The open versions after one more run, and those that it closes.

    They meet the run in a single full join: a changed key closes its version and
    opens another, a new key opens one, a missing key closes its version, an
    unchanged one keeps the values it was first seen with.
    """
    assert_unique_key(current, key)
    tracked = current.columns
    now = F.lit(run_ts).cast("timestamp")
    o = open_versions.select(F.struct(*tracked, *META).alias("o"))
    c = current.select(F.struct(*tracked).alias("c"))
    both = o.join(c, F.col(f"o.{key}") == F.col(f"c.{key}"), "full")

    gone = F.col("c").isNull()
    new = F.col("o").isNull()
    changed = ~gone & ~new & _any_differs("o", "c", check_cols)
    closes = changed | gone if invalidate_hard_deletes else changed

    kept = F.struct(
        *[F.col(f"o.{name}").alias(name) for name in tracked + META[:3]],
        F.when(closes, now).alias("dbt_valid_to"),
    )
    opened = F.struct(
        *[F.col(f"c.{name}").alias(name) for name in tracked],
        version_id(F.col(f"c.{key}"), now).alias("dbt_scd_id"),
        now.alias("dbt_updated_at"),
        now.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )
    versions = F.array_compact(F.array(F.when(~new, kept), F.when(new | changed, opened)))
    return both.select(F.inline(versions))


def _any_differs(left: str, right: str, columns: list[str]) -> Column:
    result = F.lit(False)
    for name in columns:
        result = result | differs(F.col(f"{left}.{name}"), F.col(f"{right}.{name}"))
    return result


def run_calendar(observations: DataFrame, run_col: str) -> DataFrame:
    """Every run with the one before and after it: one row per run of the whole table."""
    by_time = Window.orderBy(run_col)
    runs = observations.select(run_col).distinct()
    return runs.select(
        run_col,
        F.lag(run_col).over(by_time).alias("_prev_run"),
        F.lead(run_col).over(by_time).alias("_next_run"),
    )


def scd2_rebuild(observations: DataFrame, key: str, run_col: str, check_cols: list[str],
                 columns: list[str], runs: DataFrame | None = None) -> DataFrame:
    """The history that applying all runs in turn would give, in one pass over them.

    ``observations`` has one row per key and run. A version starts where a key is
    new, a check column changed, or the key missed a run. A key has at most one row
    per run, so the windows hold no more rows than there are runs; a repeated or NULL key
    in a run fails the job, as it does run by run.
    """
    if runs is None:
        runs = keep(run_calendar(observations, run_col), "runs")
    by_run = Window.partitionBy(key).orderBy(run_col)
    whole_key = by_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    previous_run = F.lag(run_col).over(by_run)

    starts = F.lag(F.lit(1)).over(by_run).isNull() | differs(previous_run, F.col("_prev_run"))
    for name in check_cols:
        starts = starts | differs(F.col(name), F.lag(name).over(by_run))

    refused = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"NULL {key} in a run"))).when(
        previous_run == F.col(run_col), F.raise_error(
            F.concat(F.lit(f"duplicate {key} in one run: "), F.col(key).cast("string"))))
    # The runs are a stored table of known size: Spark broadcasts them if they are few.
    seen = observations.join(runs, run_col).select(
        *columns, run_col, "_prev_run", "_next_run",
        refused.cast("boolean").alias("_refused"),
        starts.alias("_starts"),
        # the run after the last sighting of the version before this row
        F.lag("_next_run").over(by_run).alias("_before_ends"),
        F.last("_next_run").over(whole_key).alias("_key_ends"),
    )
    versions = seen.where(F.col("_starts") & F.col("_refused").isNull())
    return versions.select(
        *columns,
        version_id(F.col(key), F.col(run_col)).alias("dbt_scd_id"),
        F.col(run_col).cast("timestamp").alias("dbt_updated_at"),
        F.col(run_col).cast("timestamp").alias("dbt_valid_from"),
        F.coalesce(F.lead("_before_ends").over(by_run), F.col("_key_ends"))
         .cast("timestamp").alias("dbt_valid_to"),
    )


def snapshot_apply(spec: Snapshot, history: DataFrame | None, current: DataFrame,
                   run_ts: datetime) -> DataFrame:
    rows = current.select(*spec.columns)
    base = empty_history(rows) if history is None else history
    return scd2_apply(base, rows, spec.key, list(spec.check_cols), run_ts)


def snapshot_rebuild(spec: Snapshot, observations: DataFrame, run_col: str,
                     runs: DataFrame | None = None) -> DataFrame:
    return scd2_rebuild(observations, spec.key, run_col, list(spec.check_cols),
                        list(spec.columns), runs)


def scd2_as_of(history: DataFrame, moment: datetime | Column) -> DataFrame:
    """The versions valid at a moment; a period includes its start and not its end."""
    at = moment if isinstance(moment, Column) else F.lit(moment).cast("timestamp")
    ends = F.col("dbt_valid_to")
    return history.where((F.col("dbt_valid_from") <= at) & (ends.isNull() | (at < ends)))


def scd2_current(history: DataFrame) -> DataFrame:
    return history.where(F.col("dbt_valid_to").isNull())


def record_run(spec: Snapshot, base: str, current: DataFrame, run_ts: datetime,
               previous_run: datetime | None = None) -> None:
    """Add one run to a stored history.

    A run has a folder of its own, with the versions open after it and the ones it
    closed. It reads only the open versions of ``previous_run`` (None for the first
    run) and writes no closed version again. Recording a run anew replaces what an
    earlier attempt left.

    ``previous_run`` must be the last finished run before this one: from any other the
    versions since then would be lost without a word, so it is refused.
    """
    if previous_run is not None and previous_run >= run_ts:
        raise ValueError(f"the run of {run_ts} does not follow that of {previous_run}")
    spark = current.sparkSession
    rows = current.select(*spec.columns)
    last = _last_finished(spark, base, _run_name(run_ts))
    given = previous_run and _run_name(previous_run)
    if given != last:
        raise ValueError(f"the last finished run before {run_ts} is {last}, not {given}")
    if last is None:
        before = empty_history(rows)
    else:
        folder = f"{base}/{RUN}={last}"
        before = spark.read.option("basePath", base).parquet(folder).where(F.col(OPEN_FLAG) == 1)
    merged = merge_run(before, rows, spec.key, list(spec.check_cols), run_ts)
    flagged = merged.withColumn(OPEN_FLAG, F.col("dbt_valid_to").isNull().cast("int"))
    name, files = _run_name(run_ts), Folders(spark, base)
    for merged in _merged_folders(files, base):  # a run recorded anew is not what was merged
        if merged.first <= name <= merged.last:
            files.delete(f"{base}/{MERGED}/{merged.name}")
    replace_table(spark, f"{base}/{RUN}={name}",
                  flagged.write.partitionBy(OPEN_FLAG).parquet)


def finished_runs(spark: SparkSession, base: str) -> list[str]:
    """The names of the runs that a stored history holds whole."""
    files = Folders(spark, base)
    return [name for name in _runs(files, base) if files.exists(f"{base}/{RUN}={name}/_SUCCESS")]


def _runs(files: Folders, base: str) -> list[str]:
    return [name.removeprefix(f"{RUN}=") for name in files.names(base) if name.startswith(f"{RUN}=")]


def _last_finished(spark: SparkSession, base: str, before: str) -> str | None:
    """The last finished run before one, looked for from the end."""
    files = Folders(spark, base)
    return next((name for name in reversed(_runs(files, base))
                 if name < before and files.exists(f"{base}/{RUN}={name}/_SUCCESS")), None)


# --- merged runs ---------------------------------------------------------

@dataclass(frozen=True)
class _Merged:
    """A folder with what the runs ``first`` to ``last`` closed; a level holds FAN of the level below."""
    level: int
    first: str
    last: str

    @property
    def name(self) -> str:
        return f"{self.level}-{self.first}-{self.last}"


def _merged_folders(files: Folders, base: str) -> list[_Merged]:
    """The finished merged folders that lie in no larger one, by time."""
    found = []
    for name in files.names(f"{base}/{MERGED}"):
        level, *ends = name.split("-")
        if level.isdigit() and len(ends) == 2 and files.exists(f"{base}/{MERGED}/{name}/_SUCCESS"):
            found.append(_Merged(int(level), *ends))
    return sorted((m for m in found if not any(
        o.level > m.level and o.first <= m.first and m.last <= o.last for o in found)), key=lambda m: m.first)


def _closed(spark: SparkSession, base: str, first: str, last: str, names: list[str],
            merged: list[_Merged]) -> DataFrame | None:
    """What the runs from ``first`` to ``last`` closed, with their run; merged folders instead of runs."""
    inside = [m for m in merged if m.first <= last and m.last >= first]
    single = [n for n in names if first <= n <= last and not any(m.first <= n <= m.last for m in inside)]
    parts = []
    if inside:
        parts.append(spark.read.parquet(*(f"{base}/{MERGED}/{m.name}" for m in inside)))
    if single:
        rows = spark.read.option("basePath", base).parquet(*(f"{base}/{RUN}={n}" for n in single))
        parts.append(rows.where(F.col(OPEN_FLAG) == 0).drop(OPEN_FLAG))
    if not parts:
        return None
    every = reduce(DataFrame.unionByName, parts)
    return every.where(F.col(RUN).between(F.lit(first), F.lit(last)))


def compact_runs(spark: SparkSession, base: str, fan: int = FAN) -> list[str]:
    """Merge the closed versions of finished runs, but the last, into folders of levels.

    A folder of level n holds ``fan`` to the power of n runs, and is made of those of the level
    below, so a version is written once a level, and a read opens less than ``fan`` folders of
    each. The runs stay as they are. Returns the names of the new folders. A level below goes with
    the next call, so that reads which have begun find it.
    """
    files = Folders(spark, base)
    names = finished_runs(spark, base)[:-1]
    known = _merged_folders(files, base)
    for name in files.names(f"{base}/{MERGED}"):
        if not name.startswith(".") and name not in {m.name for m in known}:
            files.delete(f"{base}/{MERGED}/{name}")
    made, size, level = [], fan, 1
    while size <= len(names):
        for at in range(0, len(names) - size + 1, size):
            new = _Merged(level, names[at], names[at + size - 1])
            if any(m.first <= new.first and new.last <= m.last for m in known):
                continue
            rows = _closed(spark, base, new.first, new.last, names, known)
            replace_table(spark, f"{base}/{MERGED}/{new.name}", rows.hint("rebalance").write.parquet)
            made.append(new.name)
        known = _merged_folders(files, base)
        size, level = size * fan, level + 1
    return made


def read_history(spark: SparkSession, base: str, run_ts: datetime) -> DataFrame:
    """The whole history as it was after a run: what all runs closed, and what it left open."""
    name, files = _run_name(run_ts), Folders(spark, base)
    names = [n for n in _runs(files, base) if n <= name]
    merged = _merged_folders(files, base)
    if not merged or not names:
        return spark.read.parquet(base).where(
            ((F.col(OPEN_FLAG) == 0) & (F.col(RUN) <= name)) | ((F.col(OPEN_FLAG) == 1) & (F.col(RUN) == name))
        ).drop(RUN, OPEN_FLAG)
    closed = _closed(spark, base, names[0], name, names, merged).drop(RUN)
    left = spark.read.option("basePath", base).parquet(f"{base}/{RUN}={names[-1]}").where(
        (F.col(OPEN_FLAG) == 1) & (F.col(RUN) == name)).drop(RUN, OPEN_FLAG)
    return closed.unionByName(left)


def _run_name(run_ts: datetime) -> str:
    """Names in the order of time; the letter keeps Spark from reading a number."""
    return f"r{run_ts:%Y%m%dT%H%M%S%f}"

