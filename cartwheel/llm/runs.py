"""Periodic runs of words, by the diagonals on which a text matches itself.

Word i lies on the diagonal of lag q with word i - q. Going through the words, an earlier
occurrence of a word prolongs the match on its lag, and a match that ends gives a run of period
q if it is long enough: q words at least, and with the q words before it the least length of a
run. The table of lags is sparse in two ways:

* Only occurrences of the same ``reach`` words are followed, as no shorter match is enough:
  six for lags below twelve, and twice as many for each doubling of the lag.
* A match is not counted up word by word. An earlier occurrence after another word begins a
  match, one before another word ends it, and the length is what lies between. So a passage
  of period p costs nothing inside, where all multiples of p match, and the work stays in
  proportion to the words and the doublings.

Words are numbers and rows of words hashes; emitted runs are compared word by word, and
should hashes clash, the texts are done again with others.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_bytes, bound_batches, chunks, mix

#: Words of the shortest run.
LEAST = 12
#: Bytes of text worked on at once.
AT_ONCE = 1 << 20

SCHEMA = ("doc_id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
          "collapsed string")
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class HashClash(Exception):
    """Different words had equal hashes."""


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8: what lies between spaces, tabs and line breaks."""
    return text.split()


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers, and the place of each text's first word.

    A number of its own stands before each text and after the last one.
    """
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    parts, firsts, at = [], [], 0
    for k, words in enumerate(texts):
        parts += [np.array([-k - 1]), np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))]
        firsts.append(at + 1)
        at += len(words) + 1
    return np.concatenate([*parts, np.array([-len(texts) - 1])]), np.array(firsts, dtype=np.int64)


def _pairs(key: np.ndarray, label: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(later, earlier) places in the sorted ``key`` that are ``least`` to ``most`` apart and
    have different labels.

    Going back from each place, neighbours of equal label are taken or passed over together.
    """
    places = np.arange(len(key))
    low = np.searchsorted(key, key - most)
    at = np.searchsorted(key, key - least, side="right") - 1
    opens = np.r_[True, label[1:] != label[:-1]]
    first = np.maximum.accumulate(np.where(opens, places, 0))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    later = places
    while True:
        going = at >= low
        later, at, low = later[going], at[going], low[going]
        if not len(later):
            break
        begin = np.maximum(first[at], low)
        other = label[at] != label[later]
        found.append((later[other], begin[other], at[other]))
        at = begin - 1
    if not found:
        return places[:0], places[:0]
    later, begin, end = (np.concatenate(x) for x in zip(*found))
    sizes = end - begin + 1
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(later, sizes), np.repeat(begin, sizes) + inside


def _matches(words: np.ndarray, at: np.ndarray, hashes: np.ndarray, reach: int,
             lags: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, lag) of the matches of ``reach`` words or more on these lags.

    ``at`` are the last words of rows of ``reach`` words that occur more than once, sorted by
    ``hashes`` and place.
    """
    group = np.cumsum(np.r_[False, hashes[1:] != hashes[:-1]])
    key = group * (2 * len(words) + 2 * lags[1]) + at
    ends = []
    for beside in (at - reach, at + 1):
        later, earlier = _pairs(key, words[beside], *lags)
        lag, place = at[later] - at[earlier], at[later]
        order = np.lexsort((place, lag))
        ends.append((lag[order], place[order]))
    (lag, begin), (same, last) = ends
    if len(lag) != len(same) or (lag != same).any() or (begin > last).any():
        raise HashClash
    return begin - reach + 1, last, lag


def _repeated(at: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places, sorted by hash and place, whose hash occurs more than once."""
    order = np.argsort(hashes, kind="stable")
    at, hashes = at[order], hashes[order]
    more = np.zeros(len(at), dtype=bool)
    more[1:] = hashes[1:] == hashes[:-1]
    more[:-1] |= more[1:]
    return at[more], hashes[more]


def _all_runs(words: np.ndarray, firsts: np.ndarray, least: int, seed: int) -> np.ndarray:
    """Rows (start, length, period) of every run, by start, then period."""
    factor = np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
    text = np.zeros(len(words), dtype=np.int64)
    text[firsts - 1] = 1
    base = mix(words.astype(np.uint64) * factor + np.cumsum(text).astype(np.uint64) * mix(factor[None]))
    reach = (least + 1) // 2
    at = np.arange(reach, len(words) - 1)
    hashes = np.zeros(len(at), dtype=np.uint64)
    for k in range(reach):
        hashes = hashes * factor + base[at - k]
    at, hashes = _repeated(at, mix(hashes))
    found, lags = [], (1, 2 * reach - 1)
    while len(at):
        first, last, lag = _matches(words, at, hashes, reach, lags)
        size = last - first + 1
        enough = size >= np.maximum(lag, least - lag)
        found.append(np.stack([first - lag, size + lag, lag], axis=1)[enough])
        whole = np.zeros(len(words), dtype=np.uint64)
        known = np.zeros(len(words), dtype=bool)
        whole[at], known[at] = hashes, True
        at = at[(at >= 2 * reach) & known[np.maximum(at - reach, 0)]]
        at, hashes = _repeated(at, mix(whole[at] * factor + whole[at - reach]))
        reach, lags = 2 * reach, (2 * reach, 4 * reach - 1)
    if not found:
        return np.zeros((0, 3), dtype=np.int64)
    runs = np.concatenate(found)
    # The same words match at every multiple of their period: the smallest counts.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]] if len(runs) else runs
    for start, length, period in runs.tolist():
        if not np.array_equal(words[start + period:start + length], words[start:start + length - period]):
            raise HashClash
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(texts: list[list[bytes]], least: int = LEAST) -> list[np.ndarray]:
    """The runs of each text: rows (start, length, period), by start, then period."""
    words, firsts = _numbered(texts)
    seed = 0
    while True:
        try:
            runs = _all_runs(words, firsts, least, seed)
            break
        except HashClash:
            seed += 1
    owner = np.searchsorted(firsts, runs[:, 0], side="right") - 1
    runs[:, 0] -= firsts[owner]
    return np.split(runs, np.searchsorted(owner, np.arange(1, len(texts))))


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without those of a run that come after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))
    return b" ".join(words)


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Periodic runs of words in every text of ``docs`` (doc_id, text), and the text without them.

    A run is a longest stretch of words that equals itself ``period`` words on, with its
    smallest period, of ``least`` words and two periods or more. Gives a row per input row:
    doc_id, n_words, runs (start, length, period; by start, then period) and collapsed (the
    words joined by spaces, of each run only its first period). A NULL, empty or blank text has
    no words, no runs and an empty collapsed text; repeated rows stay; an empty table gives an
    empty one; other columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            sizes, runs, rest = [], [], []
            for part in chunks([len(t) for t in texts], AT_ONCE):
                cut = [words_of(t) for t in texts[part]]
                found = runs_of(cut, least)
                sizes += map(len, cut)
                runs += found
                rest += map(collapse, cut, found)
            offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            rows = np.concatenate([*runs, np.zeros((0, 3), dtype=np.int64)])
            values = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), values),
                pa.array(rest, pa.binary()).cast(pa.string()),
            ], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bound_batches(docs.select("doc_id", "text")).mapInArrow(work, SCHEMA.format(id=kind))


def digests(found: DataFrame) -> DataFrame:
    """n_runs, the longest run (ties: the first) and digests of all runs and the collapsed text.

    start, length, period and exponent_milli (thousandths of periods) are NULL without a run.
    """
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))

    def line(run: Column) -> Column:
        return F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))

    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_loops(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which about a tenth of the texts ends in a loop.

    Which, from which word a on and with which period follows from the CRC of the id; word i >= a becomes
    word a + (i - a) % period. Other texts, NULL texts and those of a NULL id stay.
    """
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    part = F.floor(crc / 10)
    n = F.size("words").cast("long")
    start = F.pmod(part, n)
    period = 1 + F.floor((n - start) / (3 + part % 8))
    once = F.slice("words", (start + 1).cast("int"), period.cast("int"))
    loops = F.ceil((n - start) / period).cast("int")
    looped = F.slice(F.concat(F.slice("words", F.lit(1), start.cast("int")),
                              F.flatten(F.array_repeat(once, loops))), F.lit(1), n.cast("int"))
    chosen = docs.select("doc_id", "text", F.when(crc % 10 == 0, words).alias("words"), crc.alias("crc"))
    return chosen.select("doc_id", F.when(
        F.size("words") > 0, F.array_join(looped, " ")).otherwise(F.col("text")).alias("text"))
