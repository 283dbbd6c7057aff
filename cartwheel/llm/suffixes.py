"""Exact repeated byte strings by distributed prefix doubling on sampled positions.

A position's name for 2k bytes is the pair of its name for k bytes and the name k bytes on.
Inside a task names double from 1 to 64 bytes. Of every window of ``length`` bytes the
position with the smallest 64-byte name is sampled; equal windows sample the same place, so a
window whose sampled name is unique is unique, and its positions are never sorted. Windows in
a row that share their sampled position travel as one run.

Spark then groups runs by name, in rounds of a longer name each:

* a name met once is dropped;
* a name whose runs are all equal is repeated with all its windows;
* a name with few different runs is settled by comparing them;
* else each run is cut at the middle of the places a window can have around its sampled
  position, and a half is named by what all windows at those places share: 64, 132, 166, …
  up to ``length`` bytes. The rounds end there.

Equal runs are one row with a count from the second round on, so copies cost nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_bytes, bound_batches, mix, packed_texts, row_keys, unpacked
from cartwheel.session import keep

#: Bytes of a string that may not be repeated, and of the names that positions are sampled by.
LENGTH = 200
NAMED = 64
#: Different runs of one name that are compared with each other.
COMPARED = 1024

#: More than any place of a window in its run.
_WIDE = 1024

#: Positions worked on at once: their places take the low bits of the sort key.
_PIECE = 1 << 15
_PLACE_BITS = np.uint64(17)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: A run in the rounds. Its window i has its sampled position ``anchor - i`` bytes on, for i up
#: to ``width``; windows of the name have it ``low`` to ``high`` bytes on. ``first`` is the
#: place of window 0 in the root run.
ITEM = ("root_name long, root_variant long, name long, variant long, first int, anchor int, "
        "low int, high int, width int, n long, content binary")


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def names_of(data: np.ndarray, size: int = NAMED) -> np.ndarray:
    """The name of the ``size`` bytes (a power of two) from each position on."""
    names = _BYTES[data]
    k = 1
    while k < size:
        longer = names[:-k] * _STEP
        longer += names[k:]
        if k in (2, 8, 32):  # not linear in the bytes
            longer ^= longer >> np.uint64(31)
            longer *= _FACTOR
        names = longer
        k *= 2
    return names


def _lowest(keys: np.ndarray, size: int) -> np.ndarray:
    """The smallest of ``size`` keys from each position on."""
    k = 1
    while 2 * k <= size:
        keys = np.minimum(keys[:-k], keys[k:])
        k *= 2
    rest = size - k
    return np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys


def string_name(content: bytes, place: int) -> int:
    """A 64-bit name of a byte string that has the sampled position ``place`` bytes on."""
    digest = hashlib.blake2b(content, digest_size=8, salt=place.to_bytes(4, "little"))
    return int.from_bytes(digest.digest(), "little", signed=True)


def runs_of(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The runs of all texts' windows: text, name, variant, first window, sampled place, last.

    The variant names the whole run: all bytes of its windows and the sampled place in them.
    Texts are worked on side by side, long ones in pieces that overlap.
    """
    found, held, size = [], [], 0
    for i, text in enumerate(texts):
        for start in range(0, len(text) - length + 1, _PIECE):
            part = text[start:start + _PIECE + length - 1]
            if size + len(part) > 2 * _PIECE and held:
                found.append(_runs_side_by_side(held, length))
                held, size = [], 0
            held.append((i, start, part))
            size += len(part)
    if held:
        found.append(_runs_side_by_side(held, length))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(column) for column in zip(*found))


def _runs_side_by_side(parts: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    sizes = np.array([len(part) for *_, part in parts])
    starts = np.cumsum(sizes) - sizes
    names = names_of(np.frombuffer(b"".join(part for *_, part in parts), dtype=np.uint8))
    keys = (names >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(names), dtype=np.uint64)
    place = _lowest(keys, length - NAMED + 1) & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))
    # Windows that reach into the next part are none.
    edges = np.zeros(len(place) + 1, dtype=np.int8)
    edges[starts] += 1
    edges[starts + sizes - length + 1] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8) > 0
    change = np.r_[True, place[1:] != place[:-1]] | np.r_[True, ~inside[:-1]]
    opens = np.flatnonzero(inside & change)
    closes = np.flatnonzero(inside & np.r_[change[1:] | ~inside[1:], True])
    at = place[opens].astype(np.int64)
    variant = mix(((closes - opens).astype(np.uint64) << np.uint64(20)) ^ (at - opens).astype(np.uint64))
    for k in range(-(-(2 * length - NAMED) // NAMED)):
        part = names[np.minimum(opens + NAMED * k, closes + length - NAMED)]
        variant = mix(variant * _STEP ^ part)
    owner = np.searchsorted(starts, opens, "right") - 1
    shift = np.array([start for _, start, _ in parts])[owner] - starts[owner]
    text = np.array([i for i, *_ in parts])[owner]
    return (text, names[at].view(np.int64), variant.view(np.int64), opens + shift, at + shift,
            closes + shift)


def _bounds(text: np.ndarray, count: int) -> np.ndarray:
    """Where each text's runs begin, and their end."""
    return np.searchsorted(text, np.arange(count + 1))


def _sampled(docs: DataFrame, length: int) -> DataFrame:
    """A row per document: its id and 128-bit key, its size and digest, its runs' names."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(3))
            text, name, variant, *_ = runs_of(texts, length)
            offsets = pa.array(_bounds(text, len(texts)), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), batch.column(2),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                pa.ListArray.from_arrays(offsets, pa.array(name)),
                pa.ListArray.from_arrays(offsets, pa.array(variant)),
            ], names=["doc_id", "k1", "k2", "n_bytes", "sha256", "names", "variants"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sampled = bound_batches(docs.select("doc_id", *row_keys(), "text")).mapInArrow(
        sample, f"doc_id {kind}, k1 long, k2 long, n_bytes long, sha256 string, "
                "names array<long>, variants array<long>")
    return sampled.withColumn("row", F.monotonically_increasing_id())


def _located(docs: DataFrame, flags: DataFrame) -> DataFrame:
    """The compressed texts of the documents with ``flags`` (k1, k2, row and the places of runs).

    Repeated rows have equal texts; one of them serves all.
    """
    return flags.dropDuplicates(["k1", "k2"]).join(packed_texts(docs), ["k1", "k2"]).dropDuplicates(
        ["k1", "k2"])


def _first_items(located: DataFrame, length: int) -> DataFrame:
    """The runs of open names with their bytes; equal runs are one row with a count."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = unpacked(batch.column(0).to_pylist())
            text, name, variant, first, place, last = runs_of(texts, length)
            begins = _bounds(text, len(texts))
            places = batch.column(1)
            at = (begins[pc.list_parent_indices(places).to_numpy()]
                  + pc.list_flatten(places).to_numpy())
            content = [texts[i][a:b] for i, a, b in zip(
                text[at].tolist(), first[at].tolist(), (last[at] + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(name[at]), pa.array(variant[at]),
                 pa.array((place[at] - first[at]).astype(np.int32)),
                 pa.array((last[at] - first[at]).astype(np.int32)), pa.array(content, pa.binary())],
                names=["name", "variant", "anchor", "width", "content"])

    runs = bound_batches(located.select("packed", "open")).mapInArrow(
        cut, "name long, variant long, anchor int, width int, content binary")
    return runs.groupBy("name", "variant").agg(
        F.count(F.lit(1)).alias("n"), F.max("anchor").alias("anchor"),
        F.max("width").alias("width"), F.max("content").alias("content")).select(
        F.col("name").alias("root_name"), F.col("variant").alias("root_variant"),
        "name", "variant", F.lit(0).alias("first"), "anchor", F.lit(0).alias("low"),
        F.lit(length - NAMED).alias("high"), "width", "n", "content")


def _side_by_side(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows, filled up with zeros, and their sizes."""
    sizes = np.array([len(p) for p in parts])
    widest = int(sizes.max(initial=0))
    rows = np.frombuffer(b"".join(p.ljust(widest, b"\0") for p in parts), dtype=np.uint8)
    return rows.reshape(len(parts), widest), sizes


def _agree(rows: np.ndarray, sizes: np.ndarray, i: int) -> np.ndarray:
    """How many leading bytes of each row are equal to those of row i."""
    own = int(sizes[i])
    if not own:
        return np.zeros(len(rows), dtype=np.int64)
    differs = rows[:, :own] != rows[i, :own]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), own)
    return np.minimum(first, sizes)


def settle(items: list[tuple], length: int) -> Iterator[tuple]:
    """The repeated windows of runs of one name, as (root_name, root_variant, from, to).

    The runs are laid over each other at what they share; how far two agree to both
    sides bounds the windows they share.
    """
    cores = [item[5] - item[6] for item in items]
    right, right_sizes = _side_by_side([item[10][c:] for item, c in zip(items, cores)])
    left, left_sizes = _side_by_side([item[10][:c][::-1] for item, c in zip(items, cores)])
    for i, (root_name, root_variant, _, _, first, _, low, high, width, n, _) in enumerate(items):
        covered = np.zeros(width + 2, dtype=np.int64)
        if n > 1:
            covered[0] += 1
        else:
            ahead = _agree(right, right_sizes, i)
            starts = np.maximum(cores[i] - _agree(left, left_sizes, i), 0)
            ends = np.minimum(cores[i] + ahead - length, width)
            # Names of different strings may meet: those do not agree on the shared bytes.
            good = (ahead >= length - (high - low)) & (starts <= ends)
            good[i] = False
            np.add.at(covered, starts[good], 1)
            np.add.at(covered, ends[good] + 1, -1)
        inside = np.r_[False, np.cumsum(covered[:-1]) > 0, False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            yield root_name, root_variant, first + start, first + end - 1


def _settled(items: DataFrame, length: int) -> DataFrame:
    """Repeated windows of names with few different runs; a task sees each name's runs in a row."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(column.to_pylist() for column in batch.columns))

        found = []
        for _, group in groupby(rows(), key=lambda r: r[2]):
            found.extend(settle(list(group), length))
            if len(found) > 100_000:
                yield _found_batch(found)
                found = []
        yield _found_batch(found)

    ordered = items.repartition("name").sortWithinPartitions("name", "variant")
    return bound_batches(ordered).mapInArrow(
        compare, "root_name long, root_variant long, low int, high int")


def _found_batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      names=["root_name", "root_variant", "low", "high"])


def _halved(items: DataFrame, length: int) -> DataFrame:
    """Each run as two, named by the bytes that all windows at the half's places share."""
    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for root_name, root_variant, _, _, first, anchor, low, high, width, n, content in zip(
                    *(column.to_pylist() for column in batch.columns)):
                middle = (low + high) // 2
                for at, to in ((low, middle), (middle + 1, high)):
                    near, far = max(anchor - width, at), min(anchor, to)
                    if near <= far:
                        part = content[anchor - far:anchor - near + length]
                        core = part[far - at:far - to + length]
                        rows.append((root_name, root_variant, string_name(core, at),
                                     string_name(part, far), first + anchor - far, far, at, to,
                                     far - near, n, part))
            columns = list(zip(*rows)) or [()] * 11
            kinds = [pa.int64()] * 4 + [pa.int32()] * 5 + [pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["root_name", "root_variant", "name", "variant", "first", "anchor", "low",
                       "high", "width", "n", "content"])

    return bound_batches(items).mapInArrow(halve, ITEM)


def _repeated_windows(items: DataFrame, length: int) -> DataFrame:
    """(root_name, root_variant, low, high): all repeated windows of the open runs."""
    found = []
    while True:
        groups = items.groupBy("name").agg(
            F.count(F.lit(1)).alias("different"), F.sum("n").alias("all"),
            F.min("variant").alias("least"), F.max("variant").alias("most"))
        state = (
            F.when(F.col("all") < 2, "unique")
            .when(F.col("least") == F.col("most"), "equal")
            .when(F.col("different") <= COMPARED, "few").otherwise("many"))
        known = keep(items.join(groups.select("name", state.alias("state")).where(
            "state <> 'unique'"), "name").select(*items.columns, "state"), "suffix-round")
        found.append(known.where("state = 'equal'").select(
            "root_name", "root_variant", F.col("first").alias("low"),
            (F.col("first") + F.col("width")).alias("high")))
        found.append(keep(_settled(known.where("state = 'few'").drop("state"), length),
                          "suffix-settled"))
        many = known.where("state = 'many'").drop("state")
        if many.isEmpty():
            break
        items = keep(_halved(many, length), "suffix-halves")
    windows = found[0]
    for more in found[1:]:
        windows = windows.unionByName(more)
    return windows


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts anywhere else.

    Works on the UTF-8 bytes of every whole text of ``docs`` (doc_id, text); strings are judged
    on the input and never cross documents. Gives a row per input row: doc_id, n_bytes,
    n_removed, n_spans (maximal removed runs) and kept_sha256 (of the bytes left, joined). A
    NULL or empty text, and one shorter than ``length``, loses nothing. Repeated rows are
    documents of their own, so such a text of ``length`` bytes or more is removed whole. An
    empty table gives an empty one; other columns are not read.
    """
    sampled = keep(_sampled(docs, length), "suffix-samples")
    runs = sampled.select(
        "row", F.posexplode(F.arrays_zip("names", "variants")).alias("place", "run")).select(
        "row", "place", F.col("run.names").alias("name"), F.col("run.variants").alias("variant"))
    names = runs.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min("variant").alias("least"), F.max("variant").alias("most"))
    repeated = keep(names.where("n > 1").select(
        F.col("name").alias("repeated"), (F.col("least") != F.col("most")).alias("open")), "suffix-names")
    hits = keep(runs.join(repeated, F.col("name") == F.col("repeated")).select(
        "row", "place", "open", "name", "variant"), "suffix-hits")
    flags = hits.groupBy("row").agg(
        F.collect_list(F.when(F.col("open"), F.col("place"))).alias("open"),
        F.collect_list(F.when(~F.col("open"), F.col("place"))).alias("equal")).join(
        sampled.select("row", "k1", "k2"), "row")
    located = keep(_located(docs, flags), "suffix-texts")

    items = keep(_first_items(located.where(F.size("open") > 0), length), "suffix-items")
    windows = _repeated_windows(items, length)
    # A span of windows in a run, as one number.
    part = F.col("place").cast("long") * _WIDE * _WIDE + F.col("low") * _WIDE + F.col("high")
    spans = (
        hits.where("open").join(windows, (F.col("name") == F.col("root_name"))
                                & (F.col("variant") == F.col("root_variant")))
        .groupBy("row").agg(F.collect_list(part).alias("parts")))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = unpacked(batch.column(2).to_pylist())
            text, _, _, first, _, last = runs_of(texts, length)
            begins = _bounds(text, len(texts))
            rows = []
            for i, content in enumerate(texts):
                equal = batch.column(3)[i].values.to_numpy() + begins[i]
                edges = np.zeros(len(content) + 1, dtype=np.int64)
                np.add.at(edges, first[equal], 1)
                np.add.at(edges, last[equal] + length, -1)
                if batch.column(4)[i].is_valid:
                    parts = batch.column(4)[i].values.to_numpy()
                    start = first[parts // _WIDE ** 2 + begins[i]]
                    np.add.at(edges, start + parts // _WIDE % _WIDE, 1)
                    np.add.at(edges, start + parts % _WIDE + length, -1)
                covered = np.cumsum(edges[:-1]) > 0
                kept = np.frombuffer(content, np.uint8)[~covered].tobytes()
                spans = int(covered[0]) + int((covered[1:] & ~covered[:-1]).sum())
                rows.append((int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [()] * 3
            kinds = [pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                names=["k1", "k2", "n_removed", "n_spans", "kept_sha256"])

    removed = bound_batches(
        located.join(spans, "row", "left").select("k1", "k2", "packed", "equal", "parts")
    ).mapInArrow(remove, "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string")
    none = F.lit(0).cast("long")
    return sampled.select("doc_id", "k1", "k2", "n_bytes", "sha256").join(
        removed, ["k1", "k2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"),
        F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))
