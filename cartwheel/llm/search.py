"""Ranked lexical search over all documents, scored once per class of equal bags.

A text is reduced to its bag: the terms it shares with the items, with their counts. Documents
of the same bag and the same length part ``m`` have the same score for every item, so they are
one class, found by a hash and told apart by the bag itself. Classes are scored in blocks
against all items, and only classes that reach an item's best are expanded to documents.

Terms, counts and weights of the items are a bounded table in every task; a larger set of items
is taken in blocks, each with a pass of its own over the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_bytes, bound_batches, ship
from cartwheel.session import keep

# Fixed value: bytes that are part of a term; all others separate. Only A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))
# Fixed values of the score.
SCALE = 1_000_000_000
SLOPE = 90

#: Documents given for an item.
BEST = 10
#: Terms of items, counted once per item, that one block holds, and bytes of these terms.
BLOCK_TERMS = 1_000_000
BLOCK_BYTES = 32 << 20
#: Scores, and pairs of a class's term and an item that holds it, held at once in a task.
SCORES_AT_ONCE = 2_000_000

BAG_SCHEMA = "doc_id {id}, n long, bag binary"
HIT_SCHEMA = "item long, score long, members array<{id}>"


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats."""
    return text.translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Block:
    """Items of one block: for each item its terms, as places in the sorted ``terms``."""
    terms: list[bytes]
    items: np.ndarray
    of_item: np.ndarray
    of_term: np.ndarray


def _item_terms(items: DataFrame) -> DataFrame:
    """item_id, item (a number) and terms: a row per different id, with all its terms once."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(set(terms_of(t))) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(terms, pa.list_(pa.binary()))], names=["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    cut_items = bound_batches(items.select("item_id", "text")).mapInArrow(
        cut, f"item_id {kind}, terms array<binary>")
    one = cut_items.groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
    return keep(one.where(F.size("terms") > 0).select(
        "item_id", F.monotonically_increasing_id().alias("item"), "terms"), "item-terms")


def _blocks(items: DataFrame) -> Iterator[Block]:
    """The items in blocks of bounded size, read one after the other."""
    held, n_terms, n_bytes = [], 0, 0
    for row in items.select("item", "terms").toLocalIterator():
        terms = [bytes(t) for t in row["terms"]]
        size = sum(map(len, terms))
        if held and (n_terms + len(terms) > BLOCK_TERMS or n_bytes + size > BLOCK_BYTES):
            yield _block(held)
            held, n_terms, n_bytes = [], 0, 0
        held.append((row["item"], terms))
        n_terms, n_bytes = n_terms + len(terms), n_bytes + size
    if held:
        yield _block(held)


def _block(held: list[tuple[int, list[bytes]]]) -> Block:
    terms = sorted({t for _, own in held for t in own})
    place = {t: i for i, t in enumerate(terms)}
    return Block(
        terms, np.array([item for item, _ in held]),
        np.repeat(np.arange(len(held)), [len(own) for _, own in held]),
        np.array([place[t] for _, own in held for t in own], dtype=np.int64))


def _bags(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats) and bag of every document with a term.

    ``bag`` has pairs of 32-bit integers, a term's place and its count, by place.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(terms)}
        for batch in batches:
            sizes, bags = [], []
            for text in as_bytes(batch.column(1)):
                found = terms_of(text)
                counts = Counter(map(place.get, found))
                counts.pop(None, None)
                sizes.append(len(found))
                bags.append(np.array(sorted(counts.items()), dtype=np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(bags, pa.binary())],
                names=["doc_id", "n", "bag"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bound_batches(docs.select("doc_id", "text")).mapInArrow(
        count, BAG_SCHEMA.format(id=kind)).where("n > 0")


def _documents_with(bags: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term: counted per task, then added up."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            pairs = np.frombuffer(b"".join(as_bytes(batch.column(0))), dtype=np.int32).reshape(-1, 2)
            total += np.bincount(pairs[:, 0], minlength=n_terms)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    counted = bags.select("bag").mapInArrow(count, "term long, df long").groupBy("term").agg(
        F.sum("df").alias("df"))
    df = np.zeros(n_terms, dtype=np.int64)
    for row in counted.toLocalIterator():
        df[row["term"]] = row["df"]
    return df


def _length_part(n: Column, documents: int, terms: int) -> Column:
    return F.expr(f"{100 - SLOPE} + ({SLOPE} * {n} * {documents}L) div {terms}L")


def _classes(bags: DataFrame, m: Column, best: int) -> DataFrame:
    """bag, m and members (the ``best`` smallest ids, ascending) of each class.

    Rows meet by the hash of bag and m, and the bag is part of the key: equal hashes of
    different bags are different classes. Each task lets at most ``best`` rows of a class
    through before they are moved, so a class of any size is no hot key.
    """
    keyed = bags.where(F.octet_length("bag") > 0).withColumn("m", m).select(
        F.xxhash64("bag", "m").alias("class"), "bag", "m", "doc_id")
    place = F.row_number().over(
        Window.partitionBy("class", "bag", "m").orderBy(F.col("doc_id").asc_nulls_last()))
    first = keyed.withColumn("place", place).where(F.col("place") <= best)
    return first.groupBy("class", "bag", "m").agg(
        F.array_sort(F.collect_list(F.struct("place", "doc_id"))).alias("members")
    ).select("bag", "m", F.col("members.doc_id").alias("members"))


class _Best:
    """The best classes of each item so far, in one task."""

    def __init__(self, n_items: int, most: int):
        self.most = most
        self.least = np.zeros(n_items, dtype=np.int64)
        self.held: list[list[tuple]] = [[] for _ in range(n_items)]

    def offer(self, scores: np.ndarray, members: list[list]) -> None:
        """``scores`` has a row per class and a column per item; members ascend."""
        better = (scores >= self.least) & (scores > 0)
        if len(scores) > self.most:
            bound = np.partition(scores, len(scores) - self.most, axis=0)[-self.most]
            better &= scores >= bound
        for k, item in zip(*(x.tolist() for x in np.nonzero(better))):
            first = members[k][0]
            self.held[item].append((-int(scores[k, item]), first is None, first or 0, members[k]))
        for item in np.flatnonzero(better.any(axis=0)).tolist():
            held = self.held[item]
            held.sort(key=lambda hit: hit[:3])
            del held[self.most:]
            if len(held) == self.most:
                self.least[item] = -held[-1][0]


@dataclass(frozen=True)
class Postings:
    """The items that hold each term: those of term t are ``items[starts[t]:starts[t + 1]]``."""
    starts: np.ndarray
    items: np.ndarray
    n_items: int
    weight: np.ndarray


def postings_of(block: Block, weight: np.ndarray) -> Postings:
    order = np.argsort(block.of_term, kind="stable")
    starts = np.searchsorted(block.of_term[order], np.arange(len(block.terms) + 1))
    return Postings(starts, block.of_item[order], len(block.items), weight)


def scores_of(bags: list[bytes], m: np.ndarray, postings: Postings) -> np.ndarray:
    """The score of each class (rows) for each item (columns), in 64-bit integers.

    Goes through the pairs of a class's term and an item that holds it, a bounded number at once.
    """
    pairs = np.frombuffer(b"".join(bags), dtype=np.int32).reshape(-1, 2).astype(np.int64)
    term, tf = pairs[:, 0], pairs[:, 1]
    row = np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags])
    part = postings.weight[term] * ((SCALE * tf) // (1000 * tf + 8 * m[row]))
    first, size = postings.starts[term], postings.starts[term + 1] - postings.starts[term]
    scores = np.zeros(len(bags) * postings.n_items, dtype=np.int64)
    ends = np.cumsum(size)
    cuts = np.searchsorted(ends, np.arange(SCORES_AT_ONCE, ends[-1] if len(ends) else 0, SCORES_AT_ONCE))
    for at in np.split(np.arange(len(term)), np.unique(cuts)):
        n = size[at]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = postings.items[np.repeat(first[at], n) + inside]
        np.add.at(scores, np.repeat(row[at] * postings.n_items, n) + item, np.repeat(part[at], n))
    return scores.reshape(len(bags), postings.n_items)


def _hits(classes: DataFrame, block: Block, weight: np.ndarray, best: int, kind: str) -> DataFrame:
    """item, score and members of the classes that may hold one of an item's best documents.

    A document among an item's ``best`` is in one of the ``best`` classes by score and first
    member, in its task as in all.
    """
    postings = postings_of(block, weight)
    numbers = block.items

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Best(postings.n_items, best)
        at_once = max(1, SCORES_AT_ONCE // postings.n_items)
        for batch in batches:
            bags, m = as_bytes(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            members, of_ids = batch.column(2).to_pylist(), batch.column(2).type
            for start in range(0, len(bags), at_once):
                now = slice(start, start + at_once)
                found.offer(scores_of(bags[now], m[now], postings), members[now])
        hits = [(item, -hit[0], hit[3]) for item, held in zip(numbers.tolist(), found.held) for hit in held]
        if hits:
            item, value, ids = zip(*hits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int64()), pa.array(value, pa.int64()), pa.array(ids, of_ids)],
                names=["item", "score", "members"])

    return bound_batches(classes.select("bag", "m", "members")).mapInArrow(score, HIT_SCHEMA.format(id=kind))


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents (doc_id, text) for each item (item_id, text) by shared terms.

    Gives item_id, rank (from 1), doc_id and score, all documents with a score above 0 if
    there are fewer. Equal scores go by ascending doc_id, NULL ids last; repeated rows are
    ranked each, copies of one id in any order. Rows of one item_id are one item with all their
    terms; a NULL item_id is an id. Texts that are NULL or without a term, and empty tables, give no rows. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = _item_terms(items)
    found = spark.createDataFrame([], f"item long, score long, doc_id {kind}")
    for block in _blocks(named):
        bags = keep(_bags(docs, block.terms), "bags")
        total = bags.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not total["documents"]:
            break
        df = _documents_with(bags, len(block.terms))
        weight = np.floor(1000 * np.log((2 * total["documents"] + 2) / (2 * df + 1))).astype(np.int64)
        classes = keep(_classes(bags, _length_part("n", total["documents"], total["terms"]), best), "classes")
        hits = _hits(classes, block, weight, best, kind)
        found = found.unionByName(hits.select("item", "score", F.explode("members").alias("doc_id")))
    place = F.row_number().over(Window.partitionBy("item").orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= best)
    return ranked.alias("r").join(named.alias("i"), F.col("r.item") == F.col("i.item")).select(
        "i.item_id", "r.rank", "r.doc_id", "r.score")
