"""Mixing sources to target weights by drawing blocks.

Each source's words are laid end to end and cut into blocks of a fixed length. A source has as
many slots as its target has blocks, and every slot draws its output shard: given the size of a
shard, its source counts are a multinomial draw, and the counts of a source add up to its slots.
A pseudorandom permutation of the source's block numbers turns a slot into a block, and slots and
documents meet on the block number.

No text is moved: a document is its size and its place in its source. Sources are rows of a
table like documents, in any number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.operators.ranking import global_place
from cartwheel.session import keep

WORD = r"[^\x20\x09-\x0D]+"
# The weights of the sources in order, repeated.
WEIGHTS = (5, 2, 1)

#: Different documents of a source that are laid out by one task.
LAID_ROWS = 4096
#: Slots, and copies of one row, that one task makes.
SLOTS_PER_TASK = 1 << 17
COPIES_PER_TASK = 1 << 14
#: Rows and bytes of names of the sources that may be broadcast.
BROADCAST_SOURCES, BROADCAST_BYTES = 50_000, 4 << 20
#: Rounds of a permutation. Products of a multiplier and a block number stay below 2^62.
ROUNDS = 4
PRODUCT_BITS = 62


@dataclass(frozen=True)
class Mix:
    """How much to take, how often a word may be taken, words of a block, slots of a shard."""
    share: float = 1.5
    most: float = 2.0
    block: int = 64
    shard_slots: int = 1 << 16
    seed: int = 7


def _primes() -> list[int]:
    """The four primes after every power of two from 2^4 to 2^29."""
    found = []
    for bits in range(4, 30):
        n, here = (1 << bits) + 1, 0
        while here < 4:
            if all(n % d for d in range(3, math.isqrt(n) + 1, 2)):
                found.append(n)
                here += 1
            n += 2
    return found


MULTIPLIERS = _primes()


def _rounds(size: Column, *key: Column) -> Column:
    """The multipliers and offsets of a permutation of 0 … size-1, drawn by hashes of ``key``.

    A multiplier is a prime that does not divide ``size``, so that a round is a bijection; fewer
    than half of the primes can divide it or be too large for it, as long as it is below 2^47.
    """
    fitting = F.filter(F.array(*map(F.lit, MULTIPLIERS)), lambda p: (size % p != 0) & (
        p.cast("long") <= F.lit(1 << PRODUCT_BITS) / F.greatest(size, F.lit(1))))

    def turn(primes: Column) -> Column:
        return F.array(*(F.struct(
            F.coalesce(F.get(primes, F.pmod(F.xxhash64(F.lit(k), *key), F.greatest(F.size(primes), F.lit(1)))
                             .cast("int")), F.lit(1)).cast("long").alias("factor"),
            F.pmod(F.xxhash64(F.lit(-k - 1), *key), F.greatest(size, F.lit(1))).cast("long").alias("offset"))
            for k in range(ROUNDS)))

    return F.element_at(F.transform(F.array(fitting), turn), 1)


def _permuted(index: Column, size: Column, rounds: Column) -> Column:
    """Where a permutation of 0 … size-1 sends ``index``.

    A round is ``factor·x + offset`` modulo the size, after which even places go to the lower
    half and odd places to the upper, which breaks up the arithmetic progression.
    """
    upper = F.floor((size + 1) / 2)

    def halves(y: Column) -> Column:
        return F.shiftright(y, 1) + F.when(y % 2 == 0, F.lit(0).cast("long")).otherwise(upper)

    def step(value: Column, turn: Column) -> Column:
        moved = F.pmod(F.pmod(value * turn["factor"], size) + turn["offset"], size)
        return F.element_at(F.transform(F.array(moved), halves), 1)

    return F.aggregate(rounds, index.cast("long"), step)


def _sized(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    return docs.select("doc_id", "source", size.alias("size"))


def _level(totals: DataFrame, mix: Mix) -> float:
    """Words of target for each unit of weight, of the sources below their most.

    Sources that reach ``most`` times their size stop there and the rest is shared anew, until no more
    reach it: one row of sums each time.
    """
    full = F.lit(False)
    stopped = None
    while True:
        sums = totals.agg(
            F.sum("words").alias("words"), F.count_if(full).alias("n"),
            F.sum(F.when(full, F.col("words")).otherwise(0)).alias("full_words"),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("open_weight")).first()
        if not sums["open_weight"]:
            return math.inf
        level = max(mix.share * sums["words"] - mix.most * sums["full_words"], 0.0) / sums["open_weight"]
        if sums["n"] == stopped:
            return level
        stopped = sums["n"]
        full = mix.most * F.col("words") < F.lit(level) * F.col("weight")


def planned_sources(sized: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """number, source, source_size, target, blocks and slots of each source of (source, size).

    Sources are numbered by code point, NULL last, and weigh 5, 2, 1, repeating.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("words"))
    numbered = keep(global_place(totals, F.col("source").isNull(), F.col("source")).select(
        F.col("place").alias("number"), "source", "words",
        F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")).alias("weight")),
        "mix-sources")
    level = _level(numbered, mix)
    most = mix.most * F.col("words")
    blocks = F.ceil(F.col("words") / mix.block)
    planned = numbered.withColumn("target", F.least(most, F.lit(level) * F.col("weight"))).withColumn("blocks", blocks)
    # A slot takes as many words as the source's blocks have on average.
    slots = F.round(F.col("target") * F.col("blocks") / F.greatest("words", F.lit(1))).cast("long")
    return keep(planned.select(
        "number", "source", F.col("words").alias("source_size"), "target", "blocks",
        F.least(slots, F.floor(mix.most * F.col("blocks"))).alias("slots")), "mix-plan")


def _bounded(sources: DataFrame) -> DataFrame:
    """Broadcast the sources if they are counted to be few, else leave their joins to Spark."""
    size = sources.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("source")).alias("bytes")).first()
    small = size["n"] <= BROADCAST_SOURCES and (size["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(sources) if small else sources


def _spread(rows: DataFrame, count: Column, each: int, tasks: int, **more: Column) -> DataFrame:
    """A row with ``nth`` from 0 to ``count``-1 for each row; a large count is shared by tasks.

    The columns ``more`` are computed once for each part of a count.
    """
    last = F.floor((count - 1) / each)
    parts = rows.where(count > 0).withColumn("_count", count).withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = parts.repartition(tasks, F.xxhash64("_part", *rows.columns)) if tasks else parts
    return dealt.withColumns(more).withColumn("nth", F.explode(F.sequence(
        F.col("_part") * each, F.least((F.col("_part") + 1) * each, F.col("_count")) - 1))).drop("_part", "_count")


def _laid_out(sized: DataFrame) -> DataFrame:
    """Documents with words and their first word's place in their source.

    Rows that are equal in id and size are one row with a number of copies. These rows are dealt to groups
    by hash; groups are laid end to end by their sums, and a group is laid out by one
    task, so a hot source, and a hot row, is shared by many.
    """
    rows = keep(sized.where(F.col("size") > 0).groupBy("source", "doc_id", "size").agg(
        F.count(F.lit(1)).alias("copies")), "mix-rows")
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies")).first()
    groups = max(1, counted["n"] // LAID_ROWS)
    words = F.col("size") * F.col("copies")
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("doc_id", "size"), F.lit(groups)))
    sums = dealt.groupBy("source", "deal").agg(F.sum(words).alias("words"))
    before = Window.partitionBy("source").orderBy("deal").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sums.select("source", "deal", F.coalesce(F.sum("words").over(before), F.lit(0))
                         .alias("start"))
    inside = Window.partitionBy("source", "deal").orderBy("doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inside", F.coalesce(F.sum(words).over(inside), F.lit(0))).alias("p")
    starts = starts.alias("s")
    firsts = placed.join(
        starts, F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.deal") == F.col("s.deal"))
    ).select("p.doc_id", "p.source", "p.size", "p.copies", (F.col("s.start") + F.col("p.inside")).alias("place"))
    many = (counted["copies"] or 0) > COPIES_PER_TASK
    tasks = max(groups, counted["copies"] // COPIES_PER_TASK) if many else 0
    return _spread(firsts, F.col("copies"), COPIES_PER_TASK, tasks).select(
        "doc_id", "source", "size", (F.col("place") + F.col("nth") * F.col("size")).alias("place"))


def drawn_blocks(sources: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """shard, number and block of every slot of the output, for the plan of sources.

    A source's slots go through all its blocks in the order of a permutation, then again in
    the order of another one.
    """
    total = sources.agg(F.sum("slots").alias("slots")).first()["slots"] or 0
    shards = max(1, -(-total // mix.shard_slots))
    seed, blocks, nth = F.lit(mix.seed), F.col("blocks"), F.col("nth")
    # A permutation for each time that the slots go through the blocks, made before there are slots.
    turns = F.array(*(_rounds(blocks, seed, F.col("number"), F.lit(turn)) for turn in range(math.ceil(mix.most) + 1)))
    planned = sources.where("slots > 0").select("number", "blocks", "slots")
    slots = _spread(planned, F.col("slots"), SLOTS_PER_TASK, max(1, total // SLOTS_PER_TASK), turns=turns)
    return slots.select(
        F.pmod(F.xxhash64(seed, "number", "nth"), F.lit(shards)).alias("shard"), "number",
        _permuted(nth % blocks, blocks, F.get("turns", F.floor(nth / blocks).cast("int"))).alias("block"))


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Take words of all ``docs`` (doc_id, text, source) so that sources meet their targets.

    Sources are ordered by code point, NULL last, and weigh 5, 2, 1, repeating. Gives a row
    per input row: doc_id, size (words), source_size, target (of its source) and taken
    (words the mix takes, repeats counted; never over ``mix.most`` times the size). Reruns
    agree. A NULL or empty text has size 0 and nothing taken; rows that are repeated are
    taken each for itself; an empty table gives an empty one; other columns are not read.
    :func:`drawn_blocks` has the shard of every block.
    """
    sized = keep(_sized(docs), "mix-sizes")
    plan = planned_sources(sized, mix)
    sources = _bounded(plan)
    named = F.col("d.source").eqNullSafe(F.col("s.source"))
    laid = _laid_out(sized).alias("d").join(sources.alias("s"), named).select("number", "doc_id", "size", "place")
    block = F.lit(mix.block)
    last = F.col("place") + F.col("size") - 1
    parts = laid.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("place") / block), F.floor(last / block)))).withColumn(
        "words", F.least(last + 1, (F.col("block") + 1) * block)
        - F.greatest(F.col("place"), F.col("block") * block))
    times = drawn_blocks(plan, mix).groupBy("number", "block").agg(F.count(F.lit(1)).alias("times"))
    # Spark takes the exploded slots to be as few as the sources: they are never to be broadcast.
    taken = (
        parts.hint("merge").join(times.hint("merge"), ["number", "block"])
        .groupBy("number", "place", "doc_id", "size")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        .select("number", "place", "taken"))
    with_words = laid.hint("merge").join(taken.hint("merge"), ["number", "place"], "left").select(
        "number", "doc_id", "size", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))
    without = sized.where(F.col("size") == 0).alias("d").join(sources.alias("s"), named).select(
        "number", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return (
        with_words.unionByName(without).join(sources.select("number", "source_size", "target"), "number")
        .select("doc_id", "size", "source_size", "target", "taken"))
