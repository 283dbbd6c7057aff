"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_FALLBACK_FOLDERS: dict[str, str] = {}


def local_session(app: str = "cartwheel", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the one you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    return tune(spark)


def tune(spark: SparkSession) -> SparkSession:
    """Settings the operators count on, for a session made elsewhere.

    Days are days in UTC. Spark may split a hot join key even where that costs
    another shuffle: without the last setting it leaves a skewed join alone when the
    grouping after it reuses the join's partitions, as the item totals per order do.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder of its own:
    on a cluster such a folder would be lost together with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK_FOLDERS:
        _FALLBACK_FOLDERS[app] = tempfile.mkdtemp(prefix="cartwheel-")
    return _FALLBACK_FOLDERS[app]


_SCOPES: dict[str, list[str]] = {}


def _scratch_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    return "/".join([shared_folder(spark), app, *_SCOPES.get(app, [])[-1:]])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder, in this application's part, not used before."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What is kept inside the block, in any of its threads, is deleted at its end.

    For a job that stores its results elsewhere; tables that still read a kept copy
    become invalid.
    """
    scopes = _SCOPES.setdefault(spark.sparkContext.applicationId, [])
    scopes.append(f"scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        clear_scratch(spark)
        scopes.pop()


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application, or the current scope, kept; tables that still read
    from it become invalid."""
    root = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several jobs need the same rows: they are computed once, survive
    the loss of executors, and the plan that made them is cut off.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(spark: SparkSession, steps: dict[str, Callable], workers: int = 4) -> dict:
    """Run independent steps at the same time, so that small ones fill idle executors.

    Gives each step's result, or the exception it ended with, in the order given.
    """
    def outcome(future: Future):
        error = future.exception()
        return future.result() if error is None else error

    with ThreadPoolExecutor(workers) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(step))
                   for name, step in steps.items()}
        return {name: outcome(future) for name, future in futures.items()}


def keep_all(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """:func:`keep` for several tables at the same time."""
    spark = next(iter(frames.values())).sparkSession
    kept = in_parallel(spark, {name: lambda df=df, name=name: keep(df, name)
                               for name, df in frames.items()})
    for result in kept.values():
        if isinstance(result, BaseException):
            raise result
    return kept
