"""Near duplicates by min-max hashing, confirmed on full shingle sets.

Documents with equal shingle sets are one node. Nodes that share a band meet in a bucket, and
buckets that share nodes make a cluster.

* A cluster of bounded size is compared by one task, which gives back the links that join it.
* In a larger cluster every node is compared with one hub first, the node most often found as
  the fullest-connected one of its buckets: copies of a text meet at the text, without
  pairs among them. What is still apart inside a bucket is then compared by pairs if the
  bucket is small, else in blocks of bounded size: its smaller groups against all of it.

Every confirmed link joins two groups and no link between different groups is left out, so
the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_bytes, bound_batches, chunks, packed_texts, row_keys, unpacked
from cartwheel.llm.shingles import WORDS, MinMax, set_key, shingle_sets
from cartwheel.session import keep

#: Bands of four values: a pair of similarity 0.8 shares none with a chance of 5e-8.
BANDS = 32
PERCENT = 80
#: Links that one task thins out.
LINKS_PER_TASK = 500_000
#: Nodes and shingles of a cluster that one task compares.
CLUSTER_NODES = 1024
CLUSTER_SHINGLES = 2_000_000
#: In larger clusters: buckets of so many nodes are compared by pairs; in larger ones, nodes and shingles of a block.
PAIRED_NODES = 64
BLOCK_NODES = 2048
BLOCK_SHINGLES = 2_000_000


def similar(shared: Column, a: Column, b: Column, percent: int = PERCENT) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _signed(docs: DataFrame, words: int, bands: int) -> DataFrame:
    """doc_id, k1, k2, name (of the set, NULL if empty), n_shingles and bands of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinMax(bands)
        for batch in batches:
            texts = as_bytes(batch.column(3))
            names, sizes, keys = [], [], []
            for run in chunks([len(t) for t in texts]):
                sets = shingle_sets(texts[run], words)
                full = [s for s in sets if len(s)]
                rows = iter(hashing.keys(full) if full else ())
                for values in sets:
                    sizes.append(len(values))
                    names.append(set_key(values) if len(values) else None)
                    keys.append(next(rows) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "k1", "k2", "name", "n_shingles", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bound_batches(docs.select("doc_id", *row_keys(), "text")).mapInArrow(
        sign, f"doc_id {kind}, k1 long, k2 long, name binary, n_shingles long, bands array<long>")


class _Forest:
    """Nodes joined so far inside a task; the smallest of a group is its root."""

    def __init__(self):
        self.root: dict = {}

    def find(self, x):
        root = x
        while self.root.get(root, root) != root:
            root = self.root[root]
        while self.root.get(x, x) != root:
            self.root[x], x = root, self.root[x]
        return root

    def join(self, a, b) -> bool:
        low, high = sorted((self.find(a), self.find(b)))
        if low != high:
            self.root[high] = low
        return low != high


def _shingled(texts: DataFrame, words: int) -> DataFrame:
    """node and its sorted shingles, of ``texts`` (node, packed)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch.column(1).to_pylist(), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return bound_batches(texts.select("node", "packed")).mapInArrow(
        cut, "node long, shingles array<long>")


def _sets(packed: list[bytes], words: int) -> list[np.ndarray]:
    """The shingles of compressed texts, sorted as signed numbers."""
    texts = unpacked(packed)
    return [np.sort(s.view(np.int64)) for run in chunks([len(t) for t in texts])
            for s in shingle_sets(texts[run], words)]


def _forest(links: DataFrame, parts: int) -> DataFrame:
    """The links that join the groups of each of ``parts`` tasks."""
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forest.join(a, b)
        nodes = list(forest.root)
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array([forest.find(x) for x in nodes], pa.int64())],
            names=["a", "b"])

    return bound_batches(links.coalesce(parts)).mapInArrow(reduce, "a long, b long").where("a > b")


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """The smallest node that each node of ``links`` (a, b: long) reaches, as (node, root).

    Tasks that read :data:`LINKS_PER_TASK` links each first thin them out to a forest. If one
    task saw all, that is the result. Otherwise every round points a node's larger
    neighbours, then its smaller ones, at the smallest; rounds are written to the shared
    folder. Nodes without a link are not listed.
    """
    def smallest(edges: DataFrame) -> DataFrame:
        return edges.groupBy("a").agg(F.min("b").alias("low")).select(
            F.col("a").alias("near"), F.least("a", "low").alias("low"))

    def marked(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38)")))
                     .first())

    # b < a in every row.
    given = keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a > b"), label)
    parts = -(-given.count() // LINKS_PER_TASK)
    edges = keep(_forest(given, max(parts, 1)), label)
    state = marked(edges) if parts > 1 else None
    while parts > 1:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (both.where("b > a").join(smallest(both), F.col("a") == F.col("near"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b")))
        large = keep(large, label)
        low = smallest(large)
        small = (large.join(low, F.col("a") == F.col("near"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(low.select(F.col("near").alias("a"), F.col("low").alias("b")))
                 .where("a > b").distinct())
        edges = keep(small, label)
        now = marked(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _confirmed(pairs: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    own = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    other = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    return (pairs.join(own, "a").join(other, "b")
            .where(similar(shared, F.size("left"), F.size("right"), percent)).select("a", "b"))


def _first_links(members: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between nodes and the hub they meet most often."""
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("full")).where("full > 1")
    shared = keep(members.join(sizes, "band").select("band", "node", "full"), "near-shared")
    degree = shared.groupBy("node").agg(F.sum("full").alias("degree"))
    ranked = keep(shared.join(degree, "node").select(
        "band", "node", F.struct("degree", "node").alias("rank")), "near-ranked")
    hubs = ranked.groupBy("band").agg(F.max("rank").alias("top"))
    met = (ranked.join(hubs, "band").where("node <> top.node")
           .groupBy("node", F.col("top.node").alias("hub"))
           .agg(F.count(F.lit(1)).alias("often"), F.first("top.degree").alias("degree")))
    best = met.groupBy("node").agg(F.max(F.struct("often", "degree", "hub")).alias("best"))
    pairs = best.select(F.col("node").alias("a"), F.col("best.hub").alias("b"))
    return _confirmed(pairs, shingles, percent)


def _partners(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted sets ``others`` are similar to the sorted set ``own``."""
    sizes = np.array([len(s) for s in others])
    flat = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    shared = np.add.reduceat((own[place] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return np.flatnonzero(100 * shared >= percent * (sizes + len(own) - shared))


def _column(rows: pa.Table, name: str) -> pa.Array:
    return rows[name].combine_chunks()


def _bands(rows: pa.Table) -> np.ndarray:
    return pc.list_flatten(_column(rows, "bands")).to_numpy().reshape(rows.num_rows, -1)


def _cluster_labels(rows: pa.Table, words: int, percent: int) -> pa.Table:
    """The smallest node that each node of a cluster reaches; pairs that share a band count."""
    forest = _Forest()
    nodes, sets = rows["node"].to_pylist(), _sets(rows["packed"].to_pylist(), words)
    sizes = np.array([len(s) for s in sets])
    bands = _bands(rows)
    for i in range(1, len(nodes)):
        n = sizes[i]
        able = 100 * np.minimum(sizes[:i], n) >= percent * np.maximum(sizes[:i], n)
        able &= (bands[:i] == bands[i]).any(axis=1)
        at = [j for j in np.flatnonzero(able) if forest.find(nodes[i]) != forest.find(nodes[j])]
        if at:
            for k in _partners(sets[i], [sets[j] for j in at], percent):
                forest.join(nodes[i], nodes[at[k]])
    return pa.table({"node": pa.array(nodes, pa.int64()),
                     "root": pa.array([forest.find(x) for x in nodes], pa.int64())})


def _block_links(rows: pa.Table, percent: int) -> pa.Table:
    """Links between groups that a block's nodes confirm; one per pair of groups it joins."""
    forest, found = _Forest(), []
    nodes, groups = rows["node"].to_pylist(), rows["grp"].to_pylist()
    band, is_left = rows["band"][0].as_py(), _column(rows, "left").to_numpy(zero_copy_only=False)
    held = _column(rows, "shingles")
    sizes = pc.list_value_length(held).to_numpy()
    sets = np.split(pc.list_flatten(held).to_numpy(), np.cumsum(sizes)[:-1])
    bands = _bands(rows)
    right = np.flatnonzero(~is_left)
    for i in np.flatnonzero(is_left):
        n = sizes[i]
        able = 100 * np.minimum(sizes[right], n) >= percent * np.maximum(sizes[right], n)
        at = right[able]
        # A pair is looked at in the first band that it shares.
        at = at[bands[i][(bands[at] == bands[i]).argmax(axis=1)] == band]
        at = [j for j in at if forest.find(groups[i]) != forest.find(groups[j])]
        if at:
            for k in _partners(sets[i], [sets[j] for j in at], percent):
                if forest.join(groups[i], groups[at[k]]):
                    found.append((nodes[i], nodes[at[k]]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                     "b": pa.array([b for _, b in found], pa.int64())})


def _other_links(members: DataFrame, shingles: DataFrame, nodes: DataFrame, roots: DataFrame,
                 percent: int) -> DataFrame:
    """Confirmed links between groups that still meet in a bucket."""
    labelled = members.join(roots, "node", "left").select(
        "band", "node", "n_shingles", F.coalesce("root", "node").alias("grp"))
    groups = labelled.groupBy("band", "grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingled"))
    apart = (groups.groupBy("band")
             .agg(F.max(F.struct("n", "grp")).alias("major"), F.sum("n").alias("full"),
                  F.sum("shingled").alias("shingled"), F.count(F.lit(1)).alias("groups"))
             .where("groups > 1").select("band", F.col("major.grp").alias("major"),
                                         "full", (F.col("full") - F.col("major.n")).alias("minor"),
                                         (F.col("shingled") / F.col("full")).alias("mean")))
    everything = keep(labelled.join(apart, "band"), "near-open")
    few = everything.where(F.col("full") <= PAIRED_NODES).select(
        "band", "node", "grp", "n_shingles")
    others = few.select(*(F.col(c).alias(f"{c}_2") for c in few.columns))
    pairs = few.join(others, (F.col("band") == F.col("band_2")) & (F.col("node") < F.col("node_2"))
                     & (F.col("grp") != F.col("grp_2"))).where(
        100 * F.least("n_shingles", "n_shingles_2") >= percent * F.greatest("n_shingles", "n_shingles_2")
    ).select(F.col("node").alias("a"), F.col("node_2").alias("b")).distinct()
    paired = _confirmed(pairs, shingles, percent)
    open_ = everything.where(F.col("full") > PAIRED_NODES)
    involved = open_.select("node").distinct()
    facts = nodes.join(involved, "node").join(shingles, "node").select(
        "node", "bands", "shingles")
    joined = open_.join(facts, "node")
    # Blocks hold a bounded number of nodes, and of shingles where the texts are long.
    per_block = F.least(F.lit(float(BLOCK_NODES)), F.lit(float(BLOCK_SHINGLES)) / F.col("mean"))
    blocks = F.ceil(F.col("full") / per_block).cast("int")
    minor_blocks = F.ceil(F.col("minor") / per_block).cast("int")
    dealt = F.abs(F.hash("node"))

    def places(side: str, count: Column, others: Column) -> Column:
        """The blocks that a node is in, on the left as one of a smaller group, or on the right."""
        mine = dealt % count
        return F.transform(F.sequence(F.lit(0), others - 1), lambda other: F.struct(
            F.lit(side == "left").alias("left"),
            (mine if side == "left" else other).alias("i"),
            (other if side == "left" else mine).alias("j")))

    right = places("right", blocks, minor_blocks)
    both = F.concat(places("left", minor_blocks, blocks), right)
    placed = joined.select(
        "band", "node", "grp", "bands", "shingles",
        F.explode(F.when(F.col("grp") != F.col("major"), both).otherwise(right)).alias("at"))

    def compare(rows: pa.Table) -> pa.Table:
        return _block_links(rows, percent)

    blocked = placed.select("band", "at.i", "at.j", "at.left", "node", "grp", "bands", "shingles").groupBy(
        "band", "i", "j").applyInArrow(compare, "a long, b long")
    return paired.unionByName(blocked)


def _labelled(docs: DataFrame, words: int, percent: int, bands: int) -> DataFrame:
    """Every row's doc_id, k1, k2, n_shingles, grp (its component, NULL without shingles) and
    component_id."""
    signed = keep(_signed(docs, words, bands), "near-signed")
    nodes = keep(signed.where("n_shingles > 0").groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("k1", "k2")).alias("key"),
        F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles"))
        .withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    every = nodes.select("node", F.explode("bands").alias("band"))
    buckets = every.groupBy("band").agg(F.count(F.lit(1)).alias("full"), F.min("node").alias("low")).where(
        "full > 1").select("band", "low")
    members = keep(every.join(buckets, "band"), "near-members")
    clusters = keep(components(members.select(F.col("node").alias("a"), F.col("low").alias("b"))),
                    "near-clusters")
    met = nodes.join(clusters, "node").select("node", "root", "bands", "n_shingles", "key.k1", "key.k2")
    large = (met.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("all"))
             .where((F.col("n") > CLUSTER_NODES) | (F.col("all") > CLUSTER_SHINGLES))
             .select("root", F.lit(True).alias("large")))
    # A document that is repeated serves once.
    texts = keep(met.join(large, "root", "left").join(packed_texts(docs), ["k1", "k2"])
                 .dropDuplicates(["k1", "k2"]).drop("k1", "k2"), "near-texts")

    def compare(rows: pa.Table) -> pa.Table:
        return _cluster_labels(rows, words, percent)

    labels = keep(texts.where("large IS NULL").select("root", "node", "bands", "packed")
                  .groupBy("root").applyInArrow(compare, "node long, root long"), "near-labels")
    rest = texts.where("large")
    if not rest.isEmpty():
        shingles = keep(_shingled(rest, words), "near-shingles")
        inside = keep(rest.select("node", "n_shingles", F.explode("bands").alias("band")), "near-large")
        first = keep(_first_links(inside, shingles, percent), "near-first")
        roots = keep(components(first), "near-roots")
        more = keep(_other_links(inside, shingles, nodes.select("node", "bands"), roots, percent), "near-more")
        labels = labels.unionByName(components(first.unionByName(more)))
    grouped = nodes.select("name", "node", "doc_id").join(labels, "node", "left").select(
        "name", "doc_id", F.coalesce("root", "node").alias("grp"))
    least = grouped.groupBy("grp").agg(F.min("doc_id").alias("least"))
    named = grouped.join(least, "grp").select(F.col("name").alias("of"), "grp", "least")
    return signed.join(named, F.col("name") == F.col("of"), "left").select(
        "doc_id", "k1", "k2", "n_shingles", "grp", F.coalesce("least", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    bands: int = BANDS) -> DataFrame:
    """Components of documents (doc_id, text) whose shingle sets are similar.

    Gives a row per input row: doc_id, n_shingles, component_id (the smallest doc_id
    reachable over links of ``percent`` or more, itself included) and kept (it is that id).
    A NULL or empty text has no shingles and no links. Repeated rows stay and fall into one
    component; a NULL doc_id counts only where its component has no other. An empty table
    gives an empty one; other columns are not read.
    """
    return _labelled(docs, words, percent, bands).select(
        "doc_id", "n_shingles", "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                            bands: int = BANDS) -> DataFrame:
    """One row of ``docs`` from each component: of its smallest doc_id; all columns stay.

    Rows without shingles are linked with nothing and all stay. Of repeated rows, and of
    rows with the smallest doc_id and different texts, one stays.
    """
    labelled = _labelled(docs, words, percent, bands)
    chosen = (labelled.where("n_shingles > 0").groupBy("grp")
              .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("c"))
              .select(F.col("c.k1").alias("chosen_1"), F.col("c.k2").alias("chosen_2")))
    bare = labelled.where("n_shingles = 0").select(
        F.col("k1").alias("chosen_1"), F.col("k2").alias("chosen_2"))
    stays = keep(chosen.withColumn("once", F.lit(True)).unionByName(
        bare.distinct().withColumn("once", F.lit(False))), "near-stays")
    k1, k2 = row_keys()
    rows = docs.select(F.struct("*").alias("_row"), k1.alias("_k1"), k2.alias("_k2")).join(
        stays, (F.col("_k1") == F.col("chosen_1")) & (F.col("_k2") == F.col("chosen_2")))
    tag = F.when(~F.col("once"), F.monotonically_increasing_id())
    return rows.withColumn("_tag", tag).dropDuplicates(["_k1", "_k2", "_tag"]).select("_row.*")
