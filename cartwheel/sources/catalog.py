"""Tables by name: raw and mart tables as parquet folders, the rest as views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.sources.replace import refuse_half_swapped, replace_table
from cartwheel.sources.versions import VersionedTable


class Tables:
    """Names of tables and the folder that holds them.

    ``layers`` says which models are stored; models of other layers stay lazy and
    are registered as temporary views. With ``versioned`` the marts are tables with versions:
    who reads one keeps the version it was given, whatever is written meanwhile.
    """

    STORED_LAYERS = frozenset({"raw", "marts", "snapshots"})
    VERSIONED_LAYERS = frozenset({"marts"})

    def __init__(self, spark: SparkSession, root: str, versioned: bool = False):
        self.spark = spark
        self.root = root
        self.versioned = versioned

    def path(self, name: str, layer: str = "raw") -> str:
        return f"{self.root}/{layer}/{name}"

    def target(self, name: str, layer: str, partition: str | None = None) -> str | VersionedTable:
        """Where a stored table is written: its folder, or the table with versions in it."""
        path = self.path(name, layer)
        if self.versioned and layer in self.VERSIONED_LAYERS:
            return VersionedTable(self.spark, path, partition)
        return path

    def table(self, name: str, layer: str = "raw") -> DataFrame:
        if layer not in self.STORED_LAYERS:
            return self.spark.table(name)
        target = self.target(name, layer)
        if isinstance(target, VersionedTable):
            return target.read()
        refuse_half_swapped(self.spark, target)
        return self.spark.read.parquet(target)

    def register(self, names: list[str], layer: str) -> None:
        """Make stored tables known to ``spark.sql`` by their names."""
        for name in names:
            self.table(name, layer).createOrReplaceTempView(name)

    def materialize(self, name: str, df: DataFrame, layer: str) -> DataFrame:
        """Store a mart, or register a staging or intermediate model as a view."""
        if layer in self.STORED_LAYERS:
            target = self.target(name, layer)
            if isinstance(target, VersionedTable):
                target.replace(df)
            else:
                replace_table(self.spark, target, df.write.parquet)
        else:
            df.createOrReplaceTempView(name)
        return self.table(name, layer)
