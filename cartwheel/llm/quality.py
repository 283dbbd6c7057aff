"""Quality by a log-likelihood ratio of n-grams, after counting rules.

Two multinomials over word unigrams and bigrams are counted: one from a trusted target
(labelled good and not toxic), one from all documents. A document's value is the mean log
ratio of its n-grams. Counting rules that need no model come first.

Documents are dealt to chunks of bounded size by their id. A chunk sends its different
n-grams (sorted hashes) with their counts to slices of the hash range, in a blob
per slice; a slice adds up what all chunks sent and answers each with the whole counts of
its n-grams in the same order. Chunks and slices grow in number with the text, so that no
task and not the driver holds the whole model; hashes grow in bits with the text.

Many chunks do not send to all slices at once, as the blobs would grow with the square. They
go through levels: a node adds up the parts of a bounded number of chunks, and passes
its sum on in parts to the next level; answers come back the same way. So each chunk, and
each node of a level, sends a bounded number of blobs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_bytes, bound_batches, unpacked
from cartwheel.session import keep

#: Bytes of text whose n-grams one task counts at once.
CHUNK = 24 << 20
#: Bytes of text that are packed together, over all chunks.
PACKED = 32 << 20
#: Values of a hash for each byte of text, and in all at least: powers of two. There are
#: fewer n-grams than bytes, so on average under one in 2^10 shares its hash, at any size.
SPARE_BITS, LEAST_BITS = 10, 40
#: Parts that a chunk or a node sends, and that a node gets, at most.
FAN = 256
#: Words whose hashes a task remembers before it starts afresh.
REMEMBERED = 200_000
#: Share of all n-grams added to both sides of a ratio: n-grams seen rarely say little.
PRIOR = 8.27e-6
#: A document is kept from this mean log ratio on.
MIN_VALUE = -0.15
#: Words of the windows whose repeats are counted, and the rules' limits.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"

SCHEMA = ("doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, value double, kept boolean")


def words_of(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """A text's words as numbers, and the different words in that numbering."""
    known: dict[bytes, int] = {}
    numbers = [known.setdefault(word, len(known)) for word in text.split()]
    return np.array(numbers, dtype=np.int64), list(known)


def repeated_words(numbers: np.ndarray, different: int, size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the text."""
    n = len(numbers) - size + 1
    if n < 2 or different == len(numbers):
        return 0
    windows = numbers[:n]
    span = max(different, 1)
    for k in range(1, size):
        windows = windows * span + numbers[k:n + k]
        if k < size - 1 and int(windows.max()) >= (1 << 62) // span:
            windows = np.unique(windows, return_inverse=True)[1]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, dtype=bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(len(numbers) + 1, dtype=np.int64)
    at = np.flatnonzero(again)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACE)]
    return len(lines) - len(set(lines))


def word_chars(text: bytes) -> int:
    """Code points in words."""
    points = len(text.decode("utf-8"))
    return points - sum(text.count(bytes([c])) for c in _SPACE)


class _WordHashes(dict):
    """The hash of 64 bits of each word asked for."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return value


def grams_of(texts: Iterable[tuple[np.ndarray, list[bytes]]], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the unigrams and bigrams of texts (as :func:`words_of` gives them), end to
    end, and how many each text has."""
    known, found = _WordHashes(), [np.zeros(0, dtype=np.uint64)]
    for numbers, different in texts:
        if len(known) > REMEMBERED:
            known.clear()
        hashes = np.fromiter(map(known.__getitem__, different), dtype=np.uint64, count=len(different))
        each = hashes[numbers]
        pairs = each[:-1] * np.uint64(0x9E3779B97F4A7C15) + each[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        found.append(np.concatenate([each, pairs]) >> np.uint64(64 - bits))
    return np.concatenate(found), np.array([len(f) for f in found[1:]], dtype=np.int64)


def _different(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of an ordered array and how often each occurs."""
    at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][:len(ordered)])
    return ordered[at], np.diff(at, append=len(ordered))


def _blob(values: np.ndarray) -> bytes:
    """64-bit values, compressed byte by byte of their significance."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _values(blob: bytes, kind: type = np.int64) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(data.reshape(8, -1).T).reshape(-1).view(kind)


def _dealt(docs: DataFrame, labels: DataFrame, chunks: int) -> DataFrame:
    """Packed texts and the ids of the trusted target, dealt to chunks by id.

    A document is in the target if any of its labels is good and none is toxic. Rows of an id
    whose texts would fill a chunk are dealt one by one, and bring along whether they are trusted.
    """
    kind = docs.schema["doc_id"].dataType
    trusted = (
        labels.select(F.col("doc_id").cast(kind).alias("doc_id"), "quality", "toxic")
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
        .where((F.col("good") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id"))
    # At most one id for every chunk's worth of text.
    hot = keep(docs.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes")).where(
        F.col("bytes") > CHUNK).select(F.col("doc_id").alias("hot_id")).join(
        trusted.select(F.col("doc_id").alias("hot_id"), F.lit(True).alias("is_trusted")), "hot_id", "left"), "hot-ids")

    def chunk(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(chunks)).alias("chunk")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=9)

        def packed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).sort_by("chunk")
            numbers = table["chunk"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(cuts, cuts[1:]):
                texts = as_bytes(table["text"].slice(start, end - start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(numbers[start])], pa.int64()),
                     pa.ListArray.from_arrays(
                         [0, end - start], table["doc_id"].slice(start, end - start).combine_chunks()),
                     pa.ListArray.from_arrays(
                         [0, end - start], table["sure"].slice(start, end - start).combine_chunks()),
                     pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                     pa.array([packer.compress(b"".join(texts))], pa.binary())],
                    names=["chunk", "ids", "sure", "lengths", "packed"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= PACKED:
                yield from packed(held)
                held, size = [], 0
        if size:
            yield from packed(held)

    number = F.monotonically_increasing_id()
    texts = docs.select("doc_id", "text").join(
        F.broadcast(hot), F.col("doc_id").eqNullSafe(F.col("hot_id")), "left").select(
        F.when(F.col("hot_id").isNotNull(), chunk(number))
         .when(F.col("doc_id").isNull(), chunk(F.xxhash64(F.coalesce("text", F.lit("")), number)))
         .otherwise(chunk(F.col("doc_id"))).alias("chunk"),
        "doc_id", "text", F.coalesce("is_trusted", F.lit(False)).alias("sure"))
    named = trusted.join(F.broadcast(hot), F.col("doc_id") == F.col("hot_id"), "left_anti").select(
        chunk(F.col("doc_id")), F.array("doc_id").alias("ids"), F.lit(None).cast("array<boolean>").alias("sure"),
        F.lit(None).cast("array<bigint>").alias("lengths"), F.lit(None).cast("binary").alias("packed"))
    packed = bound_batches(texts).mapInArrow(
        pack, f"chunk long, ids array<{kind.simpleString()}>, sure array<boolean>, lengths array<bigint>, packed binary")
    return packed.unionByName(named).repartition(chunks, "chunk")


def _texts(dealt: pa.Table) -> tuple[pa.Array, np.ndarray, list[bytes]]:
    """The ids of a chunk's documents, whether each is trusted, and their texts."""
    named = pc.is_null(dealt["packed"])
    rows = dealt.filter(pc.invert(named))
    ids, known = (pc.list_flatten(t["ids"]).combine_chunks() for t in (rows, dealt.filter(named)))
    texts = []
    for lengths, data in zip(rows["lengths"].to_pylist(), unpacked(rows["packed"].to_pylist())):
        ends = np.cumsum(lengths).tolist()
        texts += [data[end - length:end] for length, end in zip(lengths, ends)]
    sure = pc.list_flatten(rows["sure"]).combine_chunks()
    trusted = pc.or_(sure, pc.is_in(ids, value_set=known)).to_numpy(zero_copy_only=False).astype(bool)
    return ids, trusted, texts


def _levels(chunks: int) -> tuple[int, int]:
    """Parts that each chunk and node sends, and levels of nodes: parts^levels >= chunks."""
    levels = 1
    while FAN ** levels < chunks:
        levels += 1
    fan = 1
    while fan ** levels < chunks:
        fan += 1
    return fan, levels


def _edges(part: int, level: int, fan: int, levels: int, bits: int) -> np.ndarray:
    """The hashes that cut a part of a level into ``fan`` parts of the next one."""
    width = fan ** (levels - level - 1)
    return np.array([((part * fan + k) * width << bits) // fan ** levels for k in range(1, fan)], dtype=np.uint64)


_SENT = "group long, part long, child long, grams binary, raw binary, target binary"
_ANSWERED = "child long, part long, raw binary, raw_sum long, target binary, target_sum long"


def _sent(group: int, part: int, child: int, edges: np.ndarray, grams: np.ndarray, **counts: np.ndarray) -> pa.Table:
    """Ordered n-grams and their counts in parts: the group they go to, the part and who sent them."""
    cuts = np.searchsorted(grams, edges)
    n = len(edges) + 1
    steps = [_blob(np.diff(p, prepend=np.uint64(0))) for p in np.split(grams, cuts)]
    return pa.table({
        "group": pa.array([group] * n, pa.int64()), "part": pa.array(range(part * n, part * n + n), pa.int64()),
        "child": pa.array([child] * n, pa.int64()), "grams": pa.array(steps, pa.binary()),
        **{name: pa.array([_blob(p) for p in np.split(values.astype(np.int64), cuts)], pa.binary())
           for name, values in counts.items()}})


class _Node:
    """What the children of a node sent, added up."""

    def __init__(self, table: pa.Table):
        grams = [np.cumsum(_values(blob, np.uint64), dtype=np.uint64) for blob in table["grams"].to_pylist()]
        self.table, self.cuts = table, np.cumsum([len(g) for g in grams])[:-1]
        joined = np.concatenate(grams)
        self.order = np.argsort(joined, kind="stable")
        self.opens = np.r_[True, joined[self.order][1:] != joined[self.order][:-1]][:len(joined)]
        self.grams = joined[self.order][self.opens]
        self.place = np.empty(len(joined), dtype=np.int64)
        self.place[self.order] = np.cumsum(self.opens) - 1

    def total(self, name: str) -> np.ndarray:
        counts = np.concatenate([_values(blob) for blob in self.table[name].to_pylist()])
        return np.add.reduceat(counts[self.order], np.flatnonzero(self.opens)) if len(counts) else counts

    def answer(self, **whole: tuple[np.ndarray, int]) -> pa.Table:
        """To each child the whole counts of its n-grams, in its order, and their sum over the part."""
        columns = {"child": self.table["child"], "part": self.table["part"]}
        for name, (counts, total) in whole.items():
            columns[name] = pa.array([_blob(p) for p in np.split(counts[self.place], self.cuts)], pa.binary())
            columns[f"{name}_sum"] = pa.array([total] * len(self.table), pa.int64())
        return pa.table(columns)


def _counts(dealt: DataFrame, chunks: int, bits: int) -> DataFrame:
    """For each chunk and part, the counts of the chunk's n-grams in all documents and in the
    target, in the order of their hashes, and the sums of the part: child (the chunk), part,
    raw, raw_sum, target, target_sum."""
    fan, levels = _levels(chunks)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, trusted, texts = _texts(table)
        grams, lengths = grams_of(map(words_of, texts), bits)
        good, times = np.unique(grams[np.repeat(trusted, lengths)], return_counts=True)
        grams.sort()
        found, raw = _different(grams)
        target = np.zeros(len(found), dtype=np.int64)
        target[np.searchsorted(found, good)] = times
        chunk = key[0].as_py()
        sent = _sent(chunk // fan, 0, chunk, _edges(0, 0, fan, levels, bits), found, raw=raw, target=target)
        return sent if texts else sent.slice(0, 0)

    def pass_on(level: int):
        def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            group, part = (k.as_py() for k in key)
            node = _Node(table)
            return _sent(group // fan, part, group, _edges(part, level, fan, levels, bits), node.grams,
                         raw=node.total("raw"), target=node.total("target"))
        return merge

    def add(table: pa.Table) -> pa.Table:
        node = _Node(table)
        return node.answer(**{name: (total, int(total.sum())) for name in ("raw", "target")
                              for total in [node.total(name)]})

    def pass_back(table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("part")
        return _Node(table).answer(**{
            name: (np.concatenate([_values(blob) for blob in answers[name].to_pylist()]),
                   sum(answers[f"{name}_sum"].to_pylist())) for name in ("raw", "target")})

    def at_nodes(sent: DataFrame) -> DataFrame:
        return sent.repartition(chunks, "group", "part")

    sent = [dealt.groupBy("chunk").applyInArrow(count, _SENT)]
    for level in range(1, levels):
        sent[-1] = keep(sent[-1], "ngram-parts")
        sent.append(at_nodes(sent[-1]).groupBy("group", "part").applyInArrow(pass_on(level), _SENT))
    answered = at_nodes(sent.pop()).groupBy("group", "part").applyInArrow(add, _ANSWERED)
    while sent:
        back = answered.withColumn("part_of", F.floor(F.col("part") / fan))
        answered = at_nodes(sent.pop()).groupBy("group", "part").cogroup(
            back.groupBy("child", "part_of")).applyInArrow(pass_back, _ANSWERED)
    return answered


def log_ratios(counts: pa.Table) -> np.ndarray:
    """The log ratio of a chunk's n-grams, by their hash: trusted target against all documents.

    Both sides are shares of their n-grams, and so is the prior: a table of twice the
    documents of the same kind has the same ratios. Without a target all ratios are 0.
    """
    counts = counts.sort_by("part")
    raw, target = (np.concatenate([_values(blob) for blob in counts[name].to_pylist()])
                   for name in ("raw", "target"))
    raw_sum, target_sum = (sum(counts[name].to_pylist()) for name in ("raw_sum", "target_sum"))
    if not target_sum:
        return np.zeros(len(raw))
    return np.log((target / target_sum + PRIOR) / (raw / raw_sum + PRIOR))


@dataclass(frozen=True)
class Rules:
    min_words: int = MIN_WORDS
    max_repeat_percent: int = MAX_REPEAT_PERCENT
    min_value: float = MIN_VALUE


def judge(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Judge every whole text of ``docs`` (doc_id, text) with ``labels`` (doc_id, quality, toxic).

    Gives a row per input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, value (mean log ratio, 0 without words) and kept. A NULL
    or empty text has no words and fails; repeated rows stay; an empty table gives an
    empty one; without trusted labels every ratio is that of an empty target. Other
    columns are not read.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    chunks = max(size // CHUNK + 1, spark.sparkContext.defaultParallelism)
    bits = min(max(size.bit_length() + SPARE_BITS, LEAST_BITS), 64)
    dealt = _dealt(docs, labels, chunks)

    def decide(table: pa.Table, counts: pa.Table) -> pa.Table:
        ids, _, texts = _texts(table)
        found = []

        def worded() -> Iterator[tuple[np.ndarray, list[bytes]]]:
            for text in texts:
                numbers, different = words_of(text)
                n, repeats = len(numbers), repeated_words(numbers, len(different))
                failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
                found.append((n, word_chars(text), sum(text.count(bytes([c])) for c in SYMBOLS),
                              repeated_lines(text), repeats, failed))
                yield numbers, different

        grams, lengths = grams_of(worded(), bits)
        values = np.zeros(len(texts))
        if len(grams):  # summed in the order of the hashes, to hold few arrays at once
            order = np.argsort(grams).astype(np.int32 if len(grams) < 1 << 31 else np.int64)
            times = _different(grams[order])[1]
            del grams
            owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)[order]
            del order
            values = np.bincount(owner, weights=np.repeat(log_ratios(counts), times), minlength=len(texts))
            values /= np.maximum(lengths, 1)
        found = [(*row, value, not row[-1] and value >= rules.min_value)
                 for row, value in zip(found, values.tolist())]
        columns = list(zip(*found)) or [()] * 8
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        return pa.Table.from_arrays(
            [ids, *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
            names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   "n_repeat_words", "base_failed", "value", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("chunk").cogroup(_counts(dealt, chunks, bits).groupBy("child")).applyInArrow(
        decide, SCHEMA.format(id=kind))
