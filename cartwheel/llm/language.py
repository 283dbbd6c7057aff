"""Language identification in two steps: the family, then the language within it.

Linear support vector machines on hashed byte n-grams vote one against one, first between
families and then between the languages of the winning family. A document's score against
a machine is the mean weight of its n-grams, so texts of any length cost one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.batches import as_bytes, bound_batches, chunks
from cartwheel.session import keep

# Families of common language codes; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "uk"),
}

UNDETERMINED = "und"
#: Hashed features of a text.
FEATURES = 1 << 12
#: Labelled rows the machines are fitted on, over all languages (one of each at least), and the most per language.
FIT_ROWS = 3200
FIT_ROWS_PER_LANGUAGE = 400
#: Families that vote one against one; more are bundled, and a bundle has so many parts.
MAX_LANGUAGES = 200
BUNDLE = 8
#: A document is rejected when its score is below this.
MIN_SCORE = 0.5

SCHEMA = "doc_id {id}, held_out boolean, lang_pred string, score double"


def family_of(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def _folded() -> np.ndarray:
    """Letters in lower case, other ASCII as a space, bytes of other characters as they are."""
    table = np.arange(256, dtype=np.uint32)
    table[:128] = 32
    for small in range(97, 123):
        table[[small, small - 32]] = small
    return table


_FOLD = _folded()


def feature_codes(texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """The features at each byte for n-grams of 2, 3 and 4, and where each text starts.

    A text has three spaces before it and one after it, so no n-gram of it has letters of
    another one: its features do not depend on the texts beside it.
    """
    gap = b"    "
    data = _FOLD[np.frombuffer(gap[1:] + gap.join([*texts, b""]), dtype=np.uint8)]
    sizes = np.fromiter((len(t) + 4 for t in texts), dtype=np.int64, count=len(texts))
    two = (data[:-1] << 8) | data[1:]
    three = (two[:-1] << 8) | data[2:]
    four = (three[:-1] << 8) | data[3:]
    codes = []
    for gram in (two[:-2], three[:-1], four):
        mixed = gram * np.uint32(2654435761)
        codes.append(((mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822519)) >> np.uint32(20))
    return codes, np.minimum(np.cumsum(sizes) - sizes, max(len(four) - 1, 0))


def has_letter(text: bytes) -> bool:
    """Whether any character is a letter."""
    plain = text.translate(None, bytes(range(128)))
    if len(plain) < len(text) and text.upper() != text.lower():
        return True
    return bool(plain) and any(c.isalpha() for c in plain.decode("utf-8"))


def feature_rows(texts: list[bytes]) -> np.ndarray:
    """A row of mean feature counts per text."""
    rows = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for i, text in enumerate(texts):
        codes, _ = feature_codes([text])
        for part in codes:
            rows[i] += np.bincount(part, minlength=FEATURES)
        rows[i] /= max(len(codes[0]), 1)
    return rows


@dataclass(frozen=True)
class Machine:
    """A linear separator; its value is above 0 for the first of its two classes."""
    first: str
    second: str
    weights: np.ndarray
    offset: float


def fit_machine(first: str, second: str, rows: np.ndarray, is_first: np.ndarray,
                penalty: float = 1e-3, rounds: int = 20) -> Machine:
    """A support vector machine with squared hinge loss, by Newton steps on the dual weights."""
    middle = rows.mean(axis=0)
    scale = 1.0 / (rows.std(axis=0) + 1e-4)
    spread = ((rows - middle) * scale).astype(np.float64) / np.sqrt(rows.shape[1])
    side = np.where(is_first, 1.0, -1.0)
    kernel = spread @ spread.T + 1.0
    inside = np.ones(len(side), dtype=bool)
    weights = np.zeros(len(side))
    for _ in range(rounds):
        at = np.flatnonzero(inside)
        weights[:] = 0
        weights[at] = np.linalg.solve(
            kernel[np.ix_(at, at)] + penalty * len(side) * np.eye(len(at)), side[at])
        now = side * (kernel @ weights) < 1
        if (now == inside).all():
            break
        inside = now
    direction = (weights @ spread) / np.sqrt(rows.shape[1]) * scale
    return Machine(first, second, direction.astype(np.float32),
                   float(weights.sum() - middle @ direction))


@dataclass(frozen=True)
class Model:
    """Machines between families, and between the languages of each family."""
    members: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


@dataclass(frozen=True)
class Bundles:
    """Machines between bundles of families, and the model of each bundle."""
    members: dict[str, Model | Bundles]
    between: list[Machine]


def _machines(names: list[str], of: list[str], rows: np.ndarray) -> list[Machine]:
    result = []
    for first, second in combinations(names, 2):
        at = [i for i, x in enumerate(of) if x in (first, second)]
        result.append(fit_machine(first, second, rows[at], np.array([of[i] == first for i in at])))
    return result


def fit(languages: list[str], rows: np.ndarray, most: int | None = None) -> Model | Bundles:
    """Fit all machines; a family or language needs one row at least.

    More than ``most`` families (:data:`MAX_LANGUAGES`) are bundled, neighbours in the alphabet together.
    """
    families = [family_of(x) for x in languages]
    names = sorted(set(families))
    if len(names) > (MAX_LANGUAGES if most is None else most):
        return _bundled(names, families, languages, rows)
    members = {name: sorted({x for x, f in zip(languages, families) if f == name}) for name in names}
    return Model(members, _machines(names, families, rows),
                 {name: _machines(inner, languages, rows) for name, inner in members.items()})


def _bundled(names: list[str], families: list[str], languages: list[str], rows: np.ndarray) -> Bundles:
    parts = np.array_split(np.array(names, dtype=object), min(BUNDLE, -(-len(names) // BUNDLE)))
    bundle = {name: part[0] for part in parts for name in part}
    of = [bundle[f] for f in families]
    inside = {part[0]: [i for i, x in enumerate(of) if x == part[0]] for part in parts}
    return Bundles({first: fit([languages[i] for i in at], rows[at], BUNDLE) for first, at in inside.items()},
                   _machines(list(inside), of, rows))


def _vote(names: list[str], machines: list[Machine], values: list[np.ndarray],
          n: int) -> tuple[np.ndarray, np.ndarray]:
    """The index of the name with most votes, then the larger sum, and its certainty."""
    votes, sums = np.zeros((n, len(names))), np.zeros((n, len(names)))
    least = np.full((n, len(names)), np.inf)
    for machine, value in zip(machines, values):
        for name, own in ((machine.first, value), (machine.second, -value)):
            k = names.index(name)
            votes[:, k] += own > 0
            sums[:, k] += np.tanh(own)
            least[:, k] = np.minimum(least[:, k], own)
    best = np.argmax(votes + sums / (2 * len(names) + 1), axis=1)
    margin = least[np.arange(n), best]
    return best, 1.0 / (1.0 + np.exp(-4.0 * np.clip(margin, -20, 20)))


def predict(model: Model | Bundles, texts: list[bytes]) -> tuple[list[str], list[float]]:
    """The language and the certainty (0 to 1) of each text."""
    languages: list[str] = []
    scores: list[float] = []
    for run in chunks([len(t) for t in texts]):
        part = texts[run]
        codes, starts = feature_codes(part)
        sizes = np.diff(np.r_[starts, len(codes[0])]).astype(np.float64)

        def values(machines: list[Machine]) -> list[np.ndarray]:
            result = []
            for machine in machines:
                each = machine.weights[codes[0]]
                each += machine.weights[codes[1]]
                each += machine.weights[codes[2]]
                total = np.add.reduceat(each, starts, dtype=np.float64)
                result.append(total / np.maximum(sizes, 1) + machine.offset)
            return result

        names = list(model.members)
        family, certainty = _vote(names, model.between, values(model.between), len(part))
        if isinstance(model, Bundles):
            found: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(part)
            for k in set(family.tolist()):
                at = np.flatnonzero(family == k)
                for i, language, sure in zip(at, *predict(model.members[names[k]], [part[i] for i in at])):
                    found[i] = (language, float(min(certainty[i], sure)))
            languages += [language for language, _ in found]
            scores += [score for _, score in found]
            continue
        inner = {}
        for k in set(family.tolist()):
            members, machines = model.members[names[k]], model.within[names[k]]
            inner[k] = (members, *_vote(members, machines, values(machines), len(part)))
        for i, text in enumerate(part):
            members, best, sure = inner[family[i]]
            letters = has_letter(text)
            languages.append(members[best[i]] if letters else UNDETERMINED)
            scores.append(float(min(certainty[i], sure[i])) if letters else 0.0)
    return languages, scores


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame) -> Model | Bundles | None:
    """Fit on a bounded sample of labelled rows that are not held out; None without any.

    The sample has the rows with the lowest hashes of id and text, each row once:
    :data:`FIT_ROWS_PER_LANGUAGE` of a language at most and :data:`FIT_ROWS` of all, whatever the ids, but one
    of each label. Every label is learned. What reaches the driver is the feature rows of the sample.
    """
    usable = docs.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()
        & (F.length("text") > 0))
    per_language = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    if not per_language:
        return None
    want = max(1, min(FIT_ROWS_PER_LANGUAGE, FIT_ROWS // len(per_language)))
    sample = _lowest(usable, {row["lang"]: row["count"] for row in per_language}, want)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = feature_rows(as_bytes(batch.column(0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(list(rows), pa.list_(pa.float32()))],
                names=["lang", "hash", "features"])

    table = bound_batches(sample.select("text", "lang", "hash")).mapInArrow(
        features, "lang string, hash long, features array<float>").toArrow()
    order = np.lexsort((table["hash"].to_numpy(), np.array(table["lang"].to_pylist())))
    rows = np.stack(table["features"].to_numpy(zero_copy_only=False))[order]
    languages = table["lang"].to_pylist()
    return fit([languages[i] for i in order], rows)


def _lowest(usable: DataFrame, counts: dict[str, int], want: int) -> DataFrame:
    """The ``want`` different rows with the lowest hashes of each language.

    Only rows below a share of the hash range are looked at: four times the rows that should be
    needed. Where copies leave too few different ones, the share grows, up to all.
    """
    hashed = usable.withColumn("hash", F.xxhash64(F.lit("fit"), "doc_id", "text"))
    draw = F.pmod(F.col("hash"), F.lit(1 << 30))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "hash"))
    shares = {lang: min(1.0, 4 * want / n) for lang, n in counts.items()}
    while True:
        below = F.element_at(F.create_map(*(F.lit(x) for pair in shares.items() for x in pair)), F.col("lang"))
        drawn = keep(
            hashed.where(draw < below * (1 << 30)).groupBy("lang", "hash")
            .agg(F.first("text").alias("text"), F.first(draw).alias("draw"))
            .withColumn("place", place).where(F.col("place") <= want), "language-sample")
        found = {row["lang"]: row["count"] for row in drawn.groupBy("lang").count().collect()}
        short = [lang for lang, share in shares.items() if share < 1 and found.get(lang, 0) < want]
        if not short:
            return drawn
        for lang in short:
            shares[lang] = min(1.0, 16 * shares[lang])


def identify(docs: DataFrame, model: Model | Bundles | None = None) -> DataFrame:
    """The language of every whole text of ``docs`` (doc_id, text, and lang to learn from).

    Without ``model`` one is learned from ``docs`` first. Gives a row per input row: doc_id,
    held_out, lang_pred (``und`` for a NULL text or one without letters, and for all if
    there was no label to learn from) and score (0 for ``und``). Repeated rows stay and
    get equal results; an empty table gives an empty one; other columns are not read.
    """
    model = model or learn(docs)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            if model:
                languages, scores = predict(model, texts)
            else:
                languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(languages, pa.string()),
                 pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return bound_batches(rows).mapInArrow(label, SCHEMA.format(id=kind))


def accept(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the rows whose language is undetermined or uncertain.

    Kept rows keep all columns. The text is judged in the same pass that passes it on.
    """
    model = learn(docs)
    schema = docs.schema
    place = docs.columns.index("text")

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not model:
                continue
            languages, scores = predict(model, as_bytes(batch.column(place)))
            good = [x != UNDETERMINED and s >= min_score for x, s in zip(languages, scores)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return bound_batches(docs).mapInArrow(filtered, schema)
