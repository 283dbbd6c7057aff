"""Secrets in texts, in DataFrame functions only.

Base rules are regular expressions. The method adds strings whose characters look random: a
window slides over a candidate and keeps the count of each character; the counts, and the
sum of n·log2(n) over them, are updated for the character that enters and the one that
leaves. Each character class has its own threshold; known harmless shapes are suppressed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.arrays import between, let, pieces, running_max, running_sum

# The base kinds in the order that breaks ties, their patterns, the group whose
# length counts, and the least length.
ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
BASE = (
    ("assign", ASSIGN, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
ADDED = "entropy"
KINDS = (*(name for name, *_ in BASE), ADDED)

#: The characters of candidates.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Beyond the end of any text.
_FAR = 2**31 - 2
#: Candidates hold a digit; words without one are never secrets.
CANDIDATE = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}")


@dataclass(frozen=True)
class Entropy:
    """The window, the bits a class must reach in some window, and what is let through."""
    window: int = 20
    bits: tuple[tuple[str, float], ...] = (
        (r"^[0-9_=+/-]*$", math.inf),
        (r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
        (r"^[a-z0-9_-]*$", 3.7),
        (r"^[A-Z0-9_-]*$", 3.7),
        (r"", 3.9),
    )
    allowed: tuple[str, ...] = field(default=(
        r"(?i)example|sample|dummy|placeholder|changeme|your_|test_key",
        r"(.)\1{7,}",
        r"(?i)0123456789|abcdefghij",
        r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
        r"(?i)^(?:https?|www|data)[/_-]",
        r"^[0-9]{4}-[0-9]{2}-[0-9]{2}",
    ))


def _located(text: Column, pattern: str, group: int) -> Column:
    """(start, end, value) of every match; the text between matches gives the offsets."""
    kind = "array<struct<start:int,end:int,value:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    steps = F.arrays_zip(F.transform(found, lambda m: F.length(m)).alias("size"),
                         values.alias("value"), F.slice(gaps, 1, F.size(found)).alias("gap"))

    def place(given: Column) -> Column:
        ends = running_sum(F.transform(given, lambda m: m["gap"] + m["size"]))
        return F.zip_with(given, ends, lambda m, end: F.struct(
            (end - m["size"]).alias("start"), end.alias("end"), m["value"].alias("value")))

    return F.when(text.rlike(pattern), let(steps, place).cast(kind)).otherwise(F.array().cast(kind))


def _weight(n: Column) -> Column:
    """n·log2(n), 0 for 0."""
    return F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))


def most_bits(value: Column, window: int) -> Column:
    """The highest entropy, in bits a character, of any ``window`` characters of ``value``.

    The counts are a text with a character for each one of the alphabet, whose code is the
    count plus 32.
    """
    def kept(counts: Column, place: Column) -> Column:
        return F.ascii(F.substr(counts, place, F.lit(1))) - 32

    def put(counts: Column, place: Column, n: Column) -> Column:
        return F.overlay(counts, F.char(n + 32), place, F.lit(1))

    def slide(places: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            entering = F.get(places, i)
            leaving = F.when(i >= window, F.get(places, i - window)).otherwise(F.lit(0))

            def enter(n: Column) -> Column:
                return F.struct(put(state["counts"], entering, n + 1).alias("counts"),
                                (state["total"] + _weight(n + 1) - _weight(n)).alias("total"))

            def leave(held: Column) -> Column:
                return let(kept(held["counts"], leaving), lambda n: F.struct(
                    put(held["counts"], leaving, n - 1).alias("counts"),
                    (held["total"] + _weight(n - 1) - _weight(n)).alias("total")))

            def result(held: Column) -> Column:
                bits = F.lit(math.log2(window)) - held["total"] / window
                return F.struct(held["counts"].alias("counts"), held["total"].alias("total"), F.when(
                    i >= window - 1, F.greatest(state["most"], bits)).otherwise(state["most"]).alias("most"))

            entered = let(kept(state["counts"], entering), enter)
            return let(let(entered, lambda held: F.when(leaving > 0, leave(held)).otherwise(held)), result)

        start = F.struct(F.lit(" " * len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"),
                         F.lit(0.0).alias("most"))
        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), start, step, lambda state: state["most"])

    characters = F.filter(F.split(value, ""), lambda c: c != "")
    return let(F.transform(characters, lambda c: F.instr(F.lit(ALPHABET), c)), slide)


def _random(value: Column, rules: Entropy) -> Column:
    needed = F.lit(rules.bits[-1][1])
    for pattern, bits in reversed(rules.bits[:-1]):
        needed = F.when(value.rlike(pattern), F.lit(bits)).otherwise(needed)
    allowed = F.lit(False)
    for pattern in rules.allowed:
        allowed = allowed | value.rlike(pattern)
    return ~allowed & (most_bits(value, rules.window) >= needed)


def secret_spans(docs: DataFrame, rules: Entropy = Entropy()) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end), sorted.

    ``kind`` is the place in :data:`KINDS`; offsets are code points, the end is exclusive.
    ``spans`` has the base spans and those added by entropy outside of them.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    located = docs.withColumn("_found", F.struct(
        *(_located(text, pattern, group).alias(name) for name, pattern, group, _ in BASE),
        _located(text, CANDIDATE, 0).alias(ADDED)))

    def kept(place: int, name: str, least: int) -> Column:
        long_enough = F.filter(F.col(f"_found.{name}"), lambda m: F.length(m["value"]) >= least)
        return F.transform(long_enough, lambda m: F.struct(
            m["start"].alias("start"), F.lit(place).alias("kind"), m["end"].alias("end")))

    based = located.withColumn("base", F.array_sort(F.concat(
        *(kept(place, name, least) for place, (name, _, _, least) in enumerate(BASE)))))
    def apart(candidates: Column) -> Column:
        """Candidates that no base span overlaps: going by start, no span before one ends
        inside it, and none after it begins inside."""
        def mark(m: Column, added: bool) -> Column:
            return F.struct(m["start"].alias("start"), F.lit(added).alias("added"), m["end"].alias("end"),
                            (m["value"] if added else F.lit(None).cast("string")).alias("value"))

        def judged(marks: Column) -> Column:
            ends = running_max(F.transform(marks, lambda m: F.when(m["added"], -1).otherwise(m["end"])))
            ahead = running_max(F.reverse(F.transform(
                marks, lambda m: F.when(m["added"], -1).otherwise(F.lit(_FAR) - m["start"]))))
            free = F.zip_with(ends, F.reverse(ahead), lambda end, near: F.struct(
                end.alias("before"), (F.lit(_FAR) - near).alias("after")))
            return F.transform(F.filter(
                F.arrays_zip(marks.alias("m"), free.alias("f")),
                lambda x: x["m"]["added"] & (x["f"]["before"] <= x["m"]["start"]) & (x["f"]["after"] >= x["m"]["end"])),
                lambda x: x["m"])

        marks = F.array_sort(F.concat(F.transform("base", lambda b: mark(b, False)),
                                      F.transform(candidates, lambda m: mark(m, True))))
        return let(marks, judged)

    candidates = F.col(f"_found.{ADDED}")
    none = F.array().cast("array<struct<start:int,added:boolean,end:int,value:string>>")
    fresh = F.filter(F.when(F.size(candidates) > 0, apart(candidates)).otherwise(none),
                     lambda m: _random(m["value"], rules))
    added = F.transform(fresh, lambda m: F.struct(
        m["start"].alias("start"), F.lit(len(BASE)).alias("kind"), m["end"].alias("end")))
    return based.withColumn("spans", F.array_sort(F.concat("base", added))).drop("_found")


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(name) for name in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, rules: Entropy = Entropy()) -> DataFrame:
    """Secrets in every whole text of ``docs`` (doc_id, text).

    Gives a row per input row: doc_id, n_assign, n_access, n_hex, base_sha256 (of the base
    spans) and spans (all, as kind:start:end by start, then kind). A NULL or empty text has
    none; repeated rows stay; an empty table gives an empty one; other columns are not read.
    """
    found = secret_spans(docs.select("doc_id", "text"), rules)

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"),
                        listed("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: Entropy = Entropy()) -> DataFrame:
    """``docs`` with every found secret in ``text`` replaced by ``mark``, and ``n_chars`` anew.

    Overlapping spans are replaced once. All columns and rows stay; a text without secrets
    and a NULL text stay as they are.
    """
    found = secret_spans(docs.select(F.struct("*").alias("_row"), "text"), rules)

    def parts(spans: Column) -> Column:
        """For each span what lies between it and those before, and the mark; then the rest."""
        def cut(text: Column) -> Column:
            def joined(ends: Column) -> Column:
                def part(span: Column, i: Column) -> Column:
                    return let(F.when(i == 0, 0).otherwise(F.get(ends, i - 1)), lambda before: F.when(
                        span["start"] < before, F.lit("")).otherwise(
                        F.concat(between(text, before, span["start"]), F.lit(mark))))

                last = between(text, F.element_at(ends, -1), F.length("text"))
                return F.concat(F.array_join(F.transform(spans, part), ""), last)

            return let(running_max(F.transform(spans, lambda s: s["end"])), joined)

        return let(pieces(F.col("text")), cut)

    clean = F.when(F.size("spans") > 0, parts(F.col("spans"))).otherwise(F.col("text"))
    named = found.select("_row", clean.alias("_clean"))
    columns = []
    for name in docs.columns:
        value = F.col(f"_row.`{name}`")
        if name == "text":
            value = F.col("_clean")
        elif name == "n_chars":
            value = F.length("_clean").cast(docs.schema[name].dataType)
        columns.append(value.alias(name))
    return named.select(*columns)
