"""Token counts by byte-pair merging on ragged arrays.

A text is cut into pre-tokens, and a pre-token's count depends on nothing else. Those not
met before are laid end to end in one array of symbols. In each round every sequence merges
its own lowest-ranked pair, at all its places at once; sequences without a mergeable pair
leave the array. What is left of a sequence is its number of tokens.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cartwheel.llm.batches import as_texts, bound_batches, chunks

# Fixed value: how byte-level vocabularies of this family cut a text into pre-tokens.
PRE_TOKEN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
             r"|\s+(?!\S)|\s+")

#: Pre-tokens whose counts a Python worker remembers before it starts afresh.
REMEMBERED = 1_000_000
#: Pre-tokens of a long text that are held at once.
PIECE = 200_000

SCHEMA = "doc_id {id}, n_bytes long, n_tokens long, over_limit boolean"
_NEVER = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in printable else next(rest)) for b in range(256)]


class MergeTable:
    """The merges of a vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        self.size = max(ids.values()) + 1
        self.first = np.array([ids[s] for s in byte_symbols()], dtype=np.int64)
        pairs = np.array([ids[a] * self.size + ids[b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.rank = order.astype(np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], dtype=np.int64)
        self.special = [t["content"] for t in content.get("added_tokens", []) if t["special"]]
        self.words = regex.compile(PRE_TOKEN)
        self.known: dict[str, int] = {}

    def ranks(self, symbols: np.ndarray) -> np.ndarray:
        """The rank of the pair that starts at each symbol."""
        ranks = np.full(len(symbols), _NEVER)
        if len(symbols) > 1:
            pairs = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
            ranks[:-1] = np.where(self.pairs[at] == pairs, self.rank[at], _NEVER)
        return ranks


@lru_cache(maxsize=2)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def merged_lengths(table: MergeTable, sequences: list[bytes]) -> np.ndarray:
    """How many symbols are left of each non-empty byte sequence."""
    result = np.zeros(len(sequences), dtype=np.int64)
    symbols = table.first[np.frombuffer(b"".join(sequences), dtype=np.uint8)]
    lengths = np.fromiter(map(len, sequences), dtype=np.int64, count=len(sequences))
    which = np.arange(len(sequences))
    while len(which):
        ends = np.cumsum(lengths)
        ranks = table.ranks(symbols)
        ranks[ends - 1] = _NEVER
        lowest = np.minimum.reduceat(ranks, ends - lengths)
        going = lowest != _NEVER
        result[which[~going]] = lengths[~going]
        if not going.all():
            inside = np.repeat(going, lengths)
            symbols, ranks = symbols[inside], ranks[inside]
            which, lengths, lowest = which[going], lengths[going], lowest[going]
        at = np.flatnonzero(ranks == np.repeat(lowest, lengths))
        if not len(at):
            break
        # Pairs of one symbol can overlap: of such a run, every second place merges.
        opens = np.r_[True, at[1:] != at[:-1] + 1]
        run_start = np.maximum.accumulate(np.where(opens, at, 0))
        at = at[(at - run_start) % 2 == 0]
        symbols[at] = table.merged[ranks[at]]
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        owner = np.repeat(np.arange(len(which)), lengths)
        lengths = lengths - np.bincount(owner[at], minlength=len(which))
        symbols = symbols[stays]
    return result


def pre_tokens(table: MergeTable, text: str) -> Iterator[list[str]]:
    """A text's pre-tokens in bounded lists."""
    if len(text) <= 4 * PIECE:
        yield table.words.findall(text)
        return
    found = (m.group() for m in table.words.finditer(text))
    while piece := list(islice(found, PIECE)):
        yield piece


def count_tokens(table: MergeTable, texts: list[str]) -> list[int]:
    """The number of tokens of each text."""
    counts = []
    for run in chunks([len(t) for t in texts], 4 * PIECE):
        plain = []
        for text in texts[run]:
            parts, specials = [text], 0
            for special in table.special:
                cut = [piece for part in parts for piece in part.split(special)]
                specials += len(cut) - len(parts)
                parts = cut
            counts.append(specials)
            plain.append(parts)
        first = len(counts) - len(plain)
        held: list[tuple[int, list[str]]] = []
        for i, parts in enumerate(plain):
            for part in parts:
                for words in pre_tokens(table, part):
                    held.append((first + i, words))
                    if len(words) == PIECE:
                        _add(table, held, counts)
                        held = []
        _add(table, held, counts)
    return counts


def _add(table: MergeTable, held: list[tuple[int, list[str]]], counts: list[int]) -> None:
    if len(table.known) > REMEMBERED:
        table.known.clear()
    new = sorted(set().union(*(words for _, words in held)) - table.known.keys())
    if new:
        lengths = merged_lengths(table, [word.encode() for word in new])
        table.known.update(zip(new, lengths.tolist()))
    for i, words in held:
        counts[i] += sum(map(table.known.__getitem__, words))


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Tokens of every text of ``docs`` (doc_id, text) by the byte-level vocabulary at ``path``.

    ``path`` names a ``tokenizers`` JSON file that every machine has. Strings of special
    tokens inside a text count as that token. Gives a row per input row: doc_id, n_bytes,
    n_tokens, over_limit (more than ``limit`` tokens). A NULL or empty text has none;
    repeated rows stay; an empty table gives an empty one; other columns are not read.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(path)
        for batch in batches:
            texts = as_texts(batch.column(1))
            tokens = count_tokens(table, texts)
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bound_batches(docs.select("doc_id", "text")).mapInArrow(count, SCHEMA.format(id=kind))
