"""Comparing a drop, read as text, with its declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_as_text(spark: SparkSession, path: str, free_text: bool = False) -> DataFrame:
    """A CSV drop with its own header and every column as a string."""
    return (spark.read.option("header", True).option("inferSchema", False)
                 .option("multiLine", free_text).option("escape", '"')
                 .option("nullValue", "").csv(path))


def schema_conformance(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per declared or extra column: ``ok``, ``missing``, ``extra``, ``bad_values``.

    ``bad_rows`` counts values that do not cast to the declared type and NULLs in
    REQUIRED columns. All columns are counted in one pass over the drop.
    """
    present = set(raw.columns)
    declared = {f.name for f in schema}
    counts = [F.count(F.lit(1)).alias("_rows")]
    for f in schema:
        if f.name in present:
            value = F.col(f"`{f.name}`")
            bad = value.isNotNull() & value.try_cast(f.dataType).isNull()
            if not f.nullable:
                bad = bad | value.isNull()
            counts.append(F.count_if(bad).alias(f"_bad_{f.name}"))

    def entry(name: str, status, bad_rows):
        return F.struct(F.lit(name).alias("column"), status.alias("status"),
                        bad_rows.cast("bigint").alias("bad_rows"))

    entries = []
    for f in schema:
        if f.name in present:
            bad_rows = F.col(f"_bad_{f.name}")
            status = F.when(bad_rows > 0, "bad_values").otherwise("ok")
            entries.append(entry(f.name, status, bad_rows))
        else:
            entries.append(entry(f.name, F.lit("missing"), F.lit(None)))
    for name in raw.columns:
        if name not in declared:
            entries.append(entry(name, F.lit("extra"), F.lit(None)))
    return raw.agg(*counts).select(F.inline(F.array(*entries)))
