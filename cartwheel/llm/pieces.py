"""Piece ids of texts by a byte-pair model with whitespace markers, and their way back.

A space becomes a marker, and where no piece holds a marker after another character, a text
falls into marked words that are segmented without regard to each other. A task keeps a table
of the distinct words it met: each is segmented once, all new ones of a batch together on
ragged arrays, and the ids are joined back by position.
"""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_texts, bound_batches, chunks

#: Distinct words, and their characters, that a Python worker remembers before it starts afresh.
REMEMBERED = 500_000
REMEMBERED_CHARS = 12_000_000
#: Characters of a word from which it is segmented by itself, with a heap.
LONG_WORD = 64
#: Characters of texts whose words are looked up at once.
AT_ONCE = 1 << 18

# The marker of a space, the kinds of pieces, what an unknown piece reads as and
# what stands for a byte that is no part of a character.
MARKER = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_SURFACE = " ⁇ "
BROKEN = "�"

SCHEMA = "doc_id {id}, ids array<int>, decoded string"
_NEVER = np.iinfo(np.int64).max


class PieceModel:
    """The pieces of a model file, and which two of them make a third.

    A symbol is a piece, or a character that no piece of its own has. Takes byte-pair models
    with byte fallback and without a normalisation table; raises ValueError for others.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as schema
        model = schema.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        normal = model.normalizer_spec
        kinds = np.array([p.type for p in model.pieces])
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("only byte-pair models with byte fallback are read")
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("only models that keep a text's characters and spaces are read")
        if not set(kinds.tolist()) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with pieces defined by users are not read")
        self.prefix = MARKER if normal.add_dummy_prefix else ""
        self.bytes = np.zeros(256, dtype=np.int32)
        self.surfaces: list[bytes] = []
        for place, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                self.bytes[int(piece.piece[1:-1], 16)] = place
                self.surfaces.append(bytes([int(piece.piece[1:-1], 16)]))
            elif piece.type == CONTROL:
                self.surfaces.append(b"")
            elif piece.type == UNKNOWN:
                self.surfaces.append((model.trainer_spec.unk_surface or UNKNOWN_SURFACE).encode())
            else:
                self.surfaces.append(piece.piece.replace(MARKER, " ").encode())
        self.is_byte = kinds == BYTE
        self.is_control = kinds == CONTROL
        self.marked = np.array([p.type == NORMAL and p.piece.startswith(MARKER) for p in model.pieces])
        pieces = {p.piece: place for place, p in enumerate(model.pieces) if p.type == NORMAL}
        self._symbols(pieces, [p.score for p in model.pieces])
        self.words = re.compile(self._pattern(pieces))
        self.known: dict[str, bytes] = {}
        self.known_chars = 0

    def _symbols(self, pieces: dict[str, int], scores: list[float]) -> None:
        inside = sorted({c for piece in pieces for c in piece} - pieces.keys())
        self.symbols = pieces | {c: len(scores) + k for k, c in enumerate(inside)}
        self.other = len(scores) + len(inside)
        self.size = self.other + 1
        self.characters = np.full(sys.maxunicode + 1, self.other, dtype=np.int32)
        for character, symbol in self.symbols.items():
            if len(character) == 1:
                self.characters[ord(character)] = symbol
        self.n_pieces = len(scores)
        made = sorted(
            (self.symbols[piece[:cut]] * self.size + self.symbols[piece[cut:]], place)
            for piece, place in pieces.items() for cut in range(1, len(piece))
            if piece[:cut] in self.symbols and piece[cut:] in self.symbols)
        self.pairs = np.array([pair for pair, _ in made] or [-1], dtype=np.int64)
        self.made = np.array([place for _, place in made] or [0], dtype=np.int64)
        # Equal scores share a rank: of these the leftmost pair is merged, whatever its piece.
        levels = {score: rank for rank, score in enumerate(sorted({scores[p] for p in pieces.values()},
                                                                  reverse=True))}
        self.ranks = np.array([levels[scores[p]] for p in self.made] if made else [_NEVER], dtype=np.int64)

    def _pattern(self, pieces: dict[str, int]) -> str:
        """Cuts a marked text into words that no piece crosses."""
        long = [p for p in pieces if len(p) > 1]
        if any(MARKER in p.lstrip(MARKER) for p in long):
            return r"(?s).+"
        merging = "".join(map(re.escape, sorted({c for p in long for c in p} - {MARKER})))
        if not merging:
            return rf"{MARKER}+|[^{MARKER}]+"
        return rf"{MARKER}+[{merging}]*|[{merging}]+|[^{merging}{MARKER}]+"

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of symbols and the piece it makes."""
        pairs = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.ranks[at], _NEVER), self.made[at]


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def _long_word(model: PieceModel, symbols: list[int]) -> list[int]:
    """Merge one word's best pair, the leftmost of equals, until none is left."""
    after = [*range(1, len(symbols)), -1]
    before = list(range(-1, len(symbols) - 1))
    pairs: dict[tuple[int, int], tuple[int, int]] = {}

    def offer(left: int, right: int) -> None:
        key = (symbols[left], symbols[right])
        if key not in pairs:
            rank, made = model.look_up(np.array(key[:1]), np.array(key[1:]))
            pairs[key] = (int(rank[0]), int(made[0]))
        rank, made = pairs[key]
        if rank != _NEVER:
            heapq.heappush(heap, (rank, left, right, key, made))

    heap: list = []
    for left in range(len(symbols) - 1):
        offer(left, left + 1)
    while heap:
        _, left, right, key, made = heapq.heappop(heap)
        if after[left] != right or (symbols[left], symbols[right]) != key:
            continue
        symbols[left], symbols[right] = made, -1
        after[left] = after[right]
        if after[left] >= 0:
            before[after[left]] = left
            offer(left, after[left])
        after[right] = -2
        if before[left] >= 0:
            offer(before[left], left)
    return [s for s in symbols if s >= 0]


def merged(model: PieceModel, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols left of each sequence of a ragged array.

    In each round every sequence merges its own best pair, the leftmost of equals; a sequence
    without one leaves. Ranks are looked up anew only beside a merge.
    """
    left_of: list[np.ndarray] = []
    which = np.arange(len(lengths))
    final = np.zeros(len(lengths), dtype=np.int64)
    owners: list[np.ndarray] = []
    ranks = np.full(len(symbols), _NEVER)
    made = np.zeros(len(symbols), dtype=np.int64)
    if len(symbols) > 1:
        ranks[:-1], made[:-1] = model.look_up(symbols[:-1], symbols[1:])
    ranks[np.cumsum(lengths) - 1] = _NEVER
    while len(which):
        starts = np.cumsum(lengths) - lengths
        best = np.minimum.reduceat(ranks, starts)
        going = best != _NEVER
        if not going.all():
            inside = np.repeat(going, lengths)
            left_of.append(symbols[~inside])
            owners.append(np.repeat(which[~going], lengths[~going]))
            final[which[~going]] = lengths[~going]
            symbols, ranks, made = symbols[inside], ranks[inside], made[inside]
            which, lengths, best = which[going], lengths[going], best[going]
            if not len(which):
                break
            starts = np.cumsum(lengths) - lengths
        hits = np.flatnonzero(ranks == np.repeat(best, lengths))
        at = hits[np.searchsorted(hits, starts)]
        symbols[at] = made[at]
        ends = starts + lengths - 1
        stays = np.ones(len(symbols), dtype=bool)
        stays[at + 1] = False
        last = at + 1 == ends
        ranks[at] = _NEVER
        right = at[~last]
        ranks[right], made[right] = model.look_up(symbols[right], symbols[right + 2])
        left = at[at > starts]
        ranks[left - 1], made[left - 1] = model.look_up(symbols[left - 1], symbols[left])
        symbols, ranks, made = symbols[stays], ranks[stays], made[stays]
        lengths = lengths - 1
    if not left_of:
        return symbols, final
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(left_of)[order], final


def segment(model: PieceModel, words: list[str]) -> list[bytes]:
    """The ids of each distinct word as 32-bit integers."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    code_points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    symbols = model.characters[code_points].astype(np.int64)
    long = lengths > LONG_WORD
    kept, counts = merged(model, symbols[~np.repeat(long, lengths)], lengths[~long])
    short = np.flatnonzero(~long).tolist()
    ends = np.cumsum(counts)
    unknown = np.maximum.reduceat(kept, ends - counts) >= model.n_pieces if len(kept) else ends > 0
    packed = kept.astype(np.int32).tobytes()
    result: list[bytes] = [b""] * len(words)
    for place, end, size in zip(short, ends.tolist(), counts.tolist()):
        result[place] = packed[4 * (end - size):4 * end]
    for k in np.flatnonzero(unknown).tolist():
        place = short[k]
        result[place] = _with_bytes(model, words[place], kept[ends[k] - counts[k]:ends[k]])
    starts = np.cumsum(lengths) - lengths
    for place in np.flatnonzero(long).tolist():
        own = symbols[starts[place]:starts[place] + lengths[place]].tolist()
        result[place] = _with_bytes(model, words[place], np.array(_long_word(model, own)))
    return result


def _with_bytes(model: PieceModel, word: str, symbols: np.ndarray) -> bytes:
    """Ids of a word; characters without a piece are given byte by byte."""
    ids, at = [], 0
    for symbol in symbols.tolist():
        if symbol >= model.n_pieces:
            ids.extend(model.bytes[list(word[at].encode())].tolist())
            at += 1
        else:
            ids.append(symbol)
            at += len(model.surfaces[symbol].decode())
    return np.array(ids, dtype=np.int32).tobytes()


def encode(model: PieceModel, texts: list[str]) -> list[np.ndarray]:
    """The ids of each text, as the model's own library gives them."""
    result: list[np.ndarray] = []
    for run in chunks([len(t) for t in texts], AT_ONCE):
        cut = [model.words.findall((model.prefix + t).replace(" ", MARKER)) if t else [] for t in texts[run]]
        if len(model.known) > REMEMBERED or model.known_chars > REMEMBERED_CHARS:
            model.known.clear()
            model.known_chars = 0
        new = [word for word in set().union(*cut) if word not in model.known]
        if new:
            model.known.update(zip(new, segment(model, new)))
            model.known_chars += sum(map(len, new))
        result.extend(np.frombuffer(b"".join(map(model.known.__getitem__, words)), dtype=np.int32)
                      for words in cut)
    return result


def decode(model: PieceModel, ids: np.ndarray) -> str:
    """The text of piece ids.

    Byte pieces in a row are read as UTF-8, and each byte that is no part of a character
    becomes U+FFFD. The marker that begins the first piece is the added one and goes;
    control pieces have no text, and end a row of bytes.
    """
    read = ids[~model.is_control[ids]]
    if not len(read):
        return ""
    try:
        if len(read) < len(ids):
            raise ValueError("control pieces may stand between bytes")
        text = b"".join(map(model.surfaces.__getitem__, ids.tolist())).decode()
    except ValueError:
        text = _decode_runs(model, ids)
    return text[1:] if model.prefix and model.marked[read[0]] else text


def _decode_runs(model: PieceModel, ids: np.ndarray) -> str:
    parts = []
    turns = np.flatnonzero(np.diff(model.is_byte[ids])) + 1
    for run in np.split(ids, turns):
        held = b"".join(map(model.surfaces.__getitem__, run.tolist()))
        while held:
            try:
                parts.append(held.decode())
                break
            except UnicodeDecodeError as error:
                parts.append(held[:error.start].decode() + BROKEN)
                held = held[error.start + 1:]
    return "".join(parts)


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """Piece ids of every text of ``docs`` (doc_id, text), and the text read back from them.

    ``path`` names a model file that every machine has. Gives a row per input row: doc_id,
    ids (without begin or end) and decoded. A NULL or empty text has no ids and an empty
    decoded text; strings of control pieces inside a text are plain text; repeated rows stay;
    an empty table gives an empty one; other columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            ids = encode(model, as_texts(batch.column(1)))
            offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = np.concatenate([*ids, np.zeros(0, dtype=np.int32)])
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())),
                pa.array([decode(model, i) for i in ids], pa.string()),
            ], names=["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bound_batches(docs.select("doc_id", "text")).mapInArrow(work, SCHEMA.format(id=kind))


def _listed(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), ",")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas) and decoded_sha256."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(_listed(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
