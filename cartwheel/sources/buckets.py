"""Tables stored in buckets of a key, so that joins and groupings by it move no rows.

Orders, items and reviews meet on the order in several marts. Stored in the same number of
buckets of that key, they are joined and summed bucket by bucket, with a sort inside each task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Stored bytes of the tables for one bucket, and the fewest buckets.
BUCKET_BYTES, FEWEST_BUCKETS = 32 << 20, 8


def buckets_for(stored: int) -> int:
    """Buckets for tables of so many stored bytes in all, so that a bucket's share stays the same."""
    return max(FEWEST_BUCKETS, -(-stored // BUCKET_BYTES))


class BucketedTables:
    """Parquet tables below ``root``, in ``buckets`` files each, known to the session's catalog.

    The number of buckets bounds the tasks of a join, so choose it for the largest table: its
    size over what a task can sort, as for ``spark.sql.shuffle.partitions``. Tables with different
    numbers of buckets are not joined without moving rows.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int):
        if buckets < 1:
            raise ValueError("at least one bucket")
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._names: dict[str, str] = {}

    def store(self, name: str, df: DataFrame, key: str) -> DataFrame:
        """Write the rows by the hash of ``key`` and read them back; one file for a bucket.

        Storing a name again makes a new folder: who reads the old one keeps it, until :meth:`drop`.
        """
        table = f"bucketed_{name}_{uuid.uuid4().hex}"
        (df.repartition(self.buckets, key).write.format("parquet").bucketBy(self.buckets, key).sortBy(key)
           .option("path", f"{self.root}/{name}-{uuid.uuid4().hex}").saveAsTable(table))
        self._names[name] = table
        return self.spark.table(table)

    def table(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(f"no bucketed table {name}")
        return self.spark.table(self._names[name])

    def drop(self) -> None:
        """Forget the latest tables; their files stay below the root."""
        for table in self._names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._names.clear()
