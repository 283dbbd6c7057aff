"""Large CSV files with line breaks inside quotes, read by many tasks.

Where a byte range of such a file begins, nothing there tells whether it is inside quotes.
But quotes come in pairs, as a quote inside a field is doubled: a range begins inside
a field if the ranges before it hold an odd number of quotes. So the quotes of each range are
counted first, their running sum gives each range its beginning, and then every task cuts its
ranges into records. A record that goes on in the next range is put together from its
parts, at most two for a range.

Fields that hold a quote must be quoted themselves (RFC 4180); :func:`cartwheel.sources.files.write_csv`
writes so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.session import keep

#: Ranges whose beginnings are broadcast at once; more files are read in several groups.
RANGES_AT_ONCE = 200_000

_PARTS = "range long, place long, text string, opens boolean, closes boolean"


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """Lines with the range they begin in, in the order of the file within a task."""
    return spark.read.option("lineSep", "\n").text(files).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def _ranges(lines: DataFrame) -> DataFrame:
    """path, block, range (a number), inside (it begins within quotes) and stays (it ends so)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("path", "block").agg(F.sum(quotes).alias("quotes"))
    so_far = F.sum("quotes").over(Window.partitionBy("path").orderBy("block"))
    return keep(counted.select(
        "path", "block", F.monotonically_increasing_id().alias("range"),
        ((so_far - F.col("quotes")) % 2 == 1).alias("inside"), (so_far % 2 == 1).alias("stays")), "csv-ranges")


def _cutter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines (range, inside, value) as records; the first and last part of a range may be incomplete.

    ``place`` counts the parts of a range. ``opens`` and ``closes`` tell whether a part is the
    beginning and the end of its record. The inner function is sent to the tasks as it is, so
    that they need not have this package.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, place = None, False, 0
        held: list[str] = []
        opened = True

        def batch_of(parts: list[tuple]) -> pa.RecordBatch:
            ranges, places, texts, opens, closes = zip(*parts)
            return pa.RecordBatch.from_arrays([
                pa.array(ranges, pa.int64()), pa.array(places, pa.int64()), pa.array(texts, pa.string()),
                pa.array(opens), pa.array(closes)], names=["range", "place", "text", "opens", "closes"])

        for batch in batches:
            ranges = batch.column(0).to_numpy(zero_copy_only=False)
            bounds = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), len(ranges)]
            odd = pc.count_substring(batch.column(2), '"').to_numpy(zero_copy_only=False) % 2 == 1
            for start, end in zip(bounds, bounds[1:]):
                parts: list[tuple] = []
                if start < end and ranges[start] != now:
                    if held:
                        parts.append((now, place, "\n".join(held), opened, False))
                    now, place, held = int(ranges[start]), 0, []
                    inside = batch.column(1)[start].as_py()
                    opened = not inside
                after = (np.cumsum(odd[start:end]) + inside) % 2 == 1
                values = batch.column(2).slice(start, end - start).to_pylist()
                at = 0
                for close in np.flatnonzero(~after).tolist():
                    text = values[close] if close == at and not held else "\n".join(held + values[at:close + 1])
                    parts.append((now, place, text, opened, True))
                    at, place, held, opened = close + 1, place + 1, [], True
                held += values[at:]
                inside = bool(after[-1]) if len(after) else inside
                if parts:
                    yield batch_of(parts)
        if held:
            yield batch_of([(now, place, "\n".join(held), opened, False)])

    return cut


def _groups(files: dict[str, int], bytes_at_once: int) -> Iterator[list[str]]:
    held, size = [], 0
    for path, length in files.items():
        if held and size + length > bytes_at_once:
            yield held
            held, size = [], 0
        held.append(path)
        size += length
    if held:
        yield held


def _records(spark: SparkSession, files: list[str]) -> DataFrame:
    lines = _lines(spark, files)
    ranges = _ranges(lines)
    known = F.broadcast(ranges)
    begun = lines.join(known, ["path", "block"])

    def parts(of: DataFrame) -> DataFrame:
        return of.select("range", "inside", "value").mapInArrow(_cutter(), _PARTS)

    whole = parts(begun).where("opens AND closes").join(known, "range").where("block > 0 OR place > 0")
    broken = keep(parts(begun.where("inside OR stays")).where("NOT (opens AND closes)"), "csv-parts")
    number = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("path").orderBy("block", "place"))
    joined = (
        broken.join(known, "range").withColumn("record", number)
        .groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("block", "place", "text"))).alias("parts"))
        .select("path", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")))
    return whole.select("path", "text").unionByName(joined)


def read_records(spark: SparkSession, files: dict[str, int]) -> DataFrame:
    """path and text of every record of CSV files (path and size), without headers and empty lines.

    Line ends inside quotes are given as they are, in files with ``\\r\\n`` as ``\\n``. An open
    quote at the end of a file ends there.
    """
    per_range = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    found = None
    for group in _groups(files, per_range * RANGES_AT_ONCE):
        records = _records(spark, group)
        found = records if found is None else found.unionByName(records)
    text = F.when(F.endswith("text", F.lit("\r")), F.replace(
        F.regexp_replace("text", "\r$", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    return found.withColumn("text", text).where(F.trim("text") != "")
