"""Pairs of periods of one key that are valid at the same time.

A sweep over time, in parallel. Starts and ends of all periods are put in one order by key and
time, which a range partitioning does, so a key of any size lies in many tasks. In that order
a period overlaps exactly the periods that start between its start and its end. The order is
cut into buckets of equal size; a period is sent to the buckets it reaches over and meets the starts
in them. A bucket that a period reaches over as a whole gives a pair for half of its
places at least, so the rows that are moved stay in proportion to the periods and the pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators.quality import OPEN_END
from cartwheel.operators.ranking import global_place
from cartwheel.session import keep

#: Starts and ends in a bucket.
BUCKET = 1024


def overlapping_pairs(history: DataFrame, key: str, id_column: str = "dbt_scd_id",
                      start: str = "dbt_valid_from", end: str = "dbt_valid_to",
                      bucket: int = BUCKET) -> DataFrame:
    """Every two versions of a key with different ids that are valid at the same time, once.

    Gives the key, first_id and second_id (the smaller id first), and overlap_from and
    overlap_to. A version is valid from its start to before its end, without an end for ever.
    One without a start or key overlaps nothing; an empty one lies inside another, not
    at its start. Rows that repeat are pairs with the others each.
    """
    periods = keep(history.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.monotonically_increasing_id().alias("period"), F.col(key).alias("k"), F.col(id_column).alias("id"),
        F.col(start).alias("s"), F.coalesce(F.col(end), F.lit(OPEN_END).cast("timestamp")).alias("e")), "periods")
    # At one moment ends come before starts: who starts where another ends does not overlap it.
    events = periods.select("period", "k", F.explode(F.array(
        F.struct(F.col("s").alias("at"), F.lit(1).alias("kind")),
        F.struct(F.col("e").alias("at"), F.lit(0).alias("kind")))).alias("event")).select("period", "k", "event.*")
    placed = global_place(events, F.col("k"), F.col("at"), F.col("kind"), F.col("period"))
    reaches = placed.groupBy("period").agg(
        F.max(F.when(F.col("kind") == 1, F.col("place"))).alias("opens"),
        F.max(F.when(F.col("kind") == 0, F.col("place"))).alias("closes"))
    swept = keep(periods.join(reaches, "period"), "swept-periods")

    at = F.floor(F.col("opens") / bucket)
    begun = swept.select("k", F.col("id").alias("id2"), F.col("s").alias("s2"), F.col("e").alias("e2"),
                         F.col("opens").alias("opens2"), at.alias("bucket"))
    over = swept.where("closes > opens + 1").withColumn(
        "bucket", F.explode(F.sequence(at, F.floor((F.col("closes") - 1) / bucket))))
    # The size of exploded rows is not known beforehand, so neither side is broadcast.
    met = over.hint("merge").join(begun.hint("merge"), ["bucket", "k"]).where(
        (F.col("opens2") > F.col("opens")) & (F.col("opens2") < F.col("closes"))
        & (F.col("s") < F.col("e2")) & (F.col("s2") < F.col("e")) & (F.col("id") != F.col("id2")))
    return met.select(F.col("k").alias(key), F.least("id", "id2").alias("first_id"),
                      F.greatest("id", "id2").alias("second_id"),
                      F.col("s2").alias("overlap_from"), F.least("e", "e2").alias("overlap_to"))
