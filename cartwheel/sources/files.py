"""CSV and JSON-lines tables with declared schemas, kept under dated folders."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import required_columns
from cartwheel.sources.csv_ranges import read_records
from cartwheel.sources.replace import Folders


#: Rows of a CSV file that is written.
ROWS_PER_FILE = 1_000_000
#: Ends of names of files that only one task can read.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def enforce_required(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """Fail the job on a NULL in a REQUIRED column, in the pass that reads it.

    The file readers make every column nullable, so the mark is checked here. Keeps the
    columns of the schema and ``more``.
    """
    required = set(required_columns(schema))
    return df.select(*[
        F.coalesce(F.col(f.name), F.raise_error(F.lit(f"required column {f.name} is NULL"))
                   .cast(f.dataType)).alias(f.name)
        if f.name in required else F.col(f.name)
        for f in schema
    ], *more)


#: How a CSV field is read: a doubled quote is a quote, an empty field is NULL.
_CSV = {"escape": '"', "nullValue": "", "mode": "FAILFAST"}


def read_csv_table(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   free_text: bool = False, file_column: str | None = None,
                   large: int | None = None) -> DataFrame:
    """A CSV file or folder with one header row; an empty field is NULL.

    ``free_text`` allows line breaks inside quotes. Then a file of up to ``large`` bytes, by default
    the size of a partition, is read by one task, and a larger one in ranges by many, unless it
    is compressed. ``file_column`` names a column for the file that a row comes from.
    """
    def named(file) -> list:
        return [file.alias(file_column)] if file_column else []

    def plain(paths: str | list[str]) -> DataFrame:
        rows = spark.read.schema(schema).options(header=True, multiLine=free_text, **_CSV).csv(paths)
        return rows.select("*", *named(F.input_file_name()))

    def in_ranges(files: dict[str, int]) -> DataFrame:
        parsed = F.from_csv("text", schema.toDDL(), _CSV)
        records = read_records(spark, files).select("path", parsed.alias("row"))
        return records.select("row.*", *named(F.col("path")))

    big = _large_files(spark, path, large) if free_text else {}
    if not big:
        raw = plain(path)
    else:
        rest = [f for f in _files_at(spark, path) if f not in big]
        raw = in_ranges(big)
        if rest:
            raw = raw.unionByName(plain(rest))
    strings = {f.name for f in schema if isinstance(f.dataType, T.StringType)}
    no_empties = raw.select(*[
        F.nullif(F.col(c), F.lit("")).alias(c) if c in strings else F.col(c) for c in raw.columns
    ])
    return enforce_required(no_empties, schema, *([file_column] if file_column else []))


def _files_at(spark: SparkSession, path: str | list[str]) -> dict[str, int]:
    """The data files at a path, a pattern or a list of them, with their sizes."""
    paths = [path] if isinstance(path, str) else path
    return {name: size for p in paths for name, size in Folders(spark, p).data_files(p).items()}


def _large_files(spark: SparkSession, path: str | list[str], most: int | None) -> dict[str, int]:
    if most is None:
        most = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return {name: size for name, size in _files_at(spark, path).items()
            if size > most and not name.endswith(COMPRESSED)}


def read_jsonl_table(spark: SparkSession, path: str | list[str],
                     schema: T.StructType) -> DataFrame:
    """JSON lines, one object per row, matched to the schema by name."""
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return enforce_required(raw, schema)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (df.write.mode(mode).option("header", True).option("escape", '"')
       .option("maxRecordsPerFile", ROWS_PER_FILE)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def write_jsonl(df: DataFrame, base: str, load_date: date | str) -> str:
    """Replace the drop of one date; NULL fields are written, text stays UTF-8."""
    path = f"{base}/{load_date}"
    (df.write.mode("overwrite").option("ignoreNullFields", False)
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").json(path))
    return path


def drop_path(base: str, folder: str, load_date: date | str) -> str:
    return f"{base}/{folder}/{load_date}"


def read_drop(spark: SparkSession, base: str, folder: str, load_date: date | str,
              schema: T.StructType, fmt: str = "csv", free_text: bool = False) -> DataFrame:
    """One dated drop of a table."""
    return _read(spark, [drop_path(base, folder, load_date)], schema, fmt, free_text)


def read_drops(spark: SparkSession, base: str, folder: str, load_dates: Iterable[date | str],
               schema: T.StructType, fmt: str = "csv", free_text: bool = False) -> DataFrame:
    """Several dated drops as one table, with the date of the folder as ``load_date``.

    Only the folders asked for are listed and read. A date given as a text names its folder
    as it is written; it must be an ISO date, with or without hyphens.
    """
    days = {str(d): d if isinstance(d, date) else date.fromisoformat(d) for d in load_dates}
    paths = [drop_path(base, folder, d) for d in days]
    known = F.create_map(*(F.lit(x) for pair in days.items() for x in pair))
    if fmt == "csv":
        rows = read_csv_table(spark, paths, schema, free_text, file_column=_FILE)
    else:
        rows = _read(spark, paths, schema, fmt, free_text).withColumn(_FILE, F.input_file_name())
    folder = F.regexp_extract(_FILE, r"/([^/]+)/[^/]*$", 1)
    return rows.withColumn("load_date", F.element_at(known, folder)).drop(_FILE)


_FILE = "_file_of_the_row"


def dates_between(start: date, end: date) -> list[date]:
    return [start + timedelta(days=i) for i in range((end - start).days + 1)]


def _read(spark: SparkSession, paths: list[str], schema: T.StructType, fmt: str,
          free_text: bool) -> DataFrame:
    if fmt == "csv":
        return read_csv_table(spark, paths, schema, free_text)
    if fmt == "json":
        return read_jsonl_table(spark, paths, schema)
    if fmt == "parquet":
        return enforce_required(spark.read.schema(schema).parquet(*paths), schema)
    raise ValueError(f"unknown drop format {fmt!r}")
