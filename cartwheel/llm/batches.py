"""Bounded Arrow batches of texts for the operators that work in Python tasks."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of a batch handed to a Python task; a longer text is a batch alone.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20
#: Bytes of text worked on at once inside a batch, so that arrays stay in the cache.
CHUNK_BYTES = 1 << 18


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def bound_batches(df: DataFrame) -> DataFrame:
    """Make Spark hand Arrow batches of bounded size to Python, whatever the text lengths."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; NULL is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    """Each text; NULL is empty."""
    return [value or "" for value in column.to_pylist()]


def chunks(sizes: list[int], most: int = CHUNK_BYTES) -> Iterator[slice]:
    """Cut consecutive texts into runs of about ``most`` bytes, of one text at least."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all bits; different inputs give different outputs."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def row_keys() -> tuple[Column, Column]:
    """k1 and k2: a key of 128 bits of a row's id and text that only repeated rows share."""
    return (F.xxhash64("doc_id", "text").alias("k1"),
            F.xxhash64(F.lit("other"), "text", "doc_id").alias("k2"))


def packed_texts(docs: DataFrame) -> DataFrame:
    """k1, k2 and the compressed text of every row with a text, for joins that move texts."""
    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([packer.compress(t) for t in as_bytes(batch.column(2))], pa.binary())],
                names=["k1", "k2", "packed"])

    texts = docs.select(*row_keys(), "text").where(F.octet_length("text") > 0)
    return bound_batches(texts).mapInArrow(compress, "k1 long, k2 long, packed binary")


def unpacked(values: list[bytes]) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(value) for value in values]
