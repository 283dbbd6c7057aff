"""Benchmark decontamination by templates, in DataFrame functions only.

A text becomes words with typed placeholders for numbers, units and names. Windows of such
templates are joined by hash, so a question is found again when its numbers or names were
changed; windows that hold a name are also joined with the name as a plain word, so that a copy
in other letters is found too. A joined window lays an item beside a place of a document. There
item and document are compared word by word, and the slots must be filled consistently: a value
of the benchmark stands for one value of the document wherever it occurs.

Windows that few items have lay these items one by one. A window that many items share lays their
class, the items with the same shared windows at the same places, as one; the class is
expanded only where its items are compared, so that no table of all its documents and all its
items is made, and none of them is left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.session import keep

# The mark of a slot, and words that are units where they follow a number.
_SLOT = "\u0001"
UNITS = ("mm", "cm", "m", "km", "mg", "g", "kg", "ml", "l", "s", "min", "h", "hours", "minutes",
         "seconds", "days", "weeks", "months", "years", "meters", "metres", "miles", "feet",
         "inches", "pounds", "dollars", "euros", "percent", "liters", "litres", "grams", "degrees",
         "hour", "minute", "second", "day", "week", "month", "year", "meter", "metre", "mile", "foot",
         "inch", "pound", "dollar", "euro", "liter", "litre", "gram", "degree")

#: Windows of the benchmark, and documents with a candidate, that may be broadcast (32 bytes each).
BROADCAST_WINDOWS = 500_000
#: Items with fewer words are looked for as they are, without slots.
LITERAL = 3


@dataclass(frozen=True)
class Templates:
    """What is a leak.

    ``window``: words of a window, ``short`` for items of less than two windows, so that one
    edited word leaves a window. ``coverage``: the share of an item's words that a leak
    holds; ``least``: words it holds anyway, all but one if the item has no more. Items with
    fewer are found as a whole. ``run``: words in a row that are a leak whatever their share.
    ``consistency``: the share of an item's slot values that one value of the document each
    must stand for. ``shared``: a window of more items than that is a prompt, which lays its items
    as classes; that changes the work, not what is found.
    """
    window: int = 7
    short: int = 4
    coverage: float = 0.5
    least: int = 8
    run: int = 13
    consistency: float = 0.85
    shared: int = 20


def template_words(text: Column) -> Column:
    """The words of a text in lower case; a slot is the mark, its type and its value.

    Types: ``n`` a number, ``u`` a unit after a number, ``p`` a name (a capitalised word
    inside a sentence). No pattern repeats a group of alternatives: the regex engine would
    recurse for each repeat, and a long row of separators would overflow its stack. The patterns look
    for the rare character first and behind it only there.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), f"{_SLOT}\t\n\r", "    ")
    numbered = F.regexp_replace(plain, r"[0-9]+(?:[.,][0-9]+)*+", f" {_SLOT}n$0 ")
    units = F.regexp_replace(
        numbered, rf"({_SLOT}n[0-9.,]+) +(?i:({'|'.join(UNITS)}))(?![\p{{L}}\p{{N}}])", rf"$1 {_SLOT}u$2")
    united = F.when(F.contains(numbered, F.lit(_SLOT)), units).otherwise(numbered)
    named = F.regexp_replace(united, r"(?=\p{Lu}\p{Ll})(?<=[\p{Ll},;] {1,4})\p{Lu}\p{Ll}+", f"{_SLOT}p$0")
    pointless = F.regexp_replace(F.lower(named), r"[.,](?:(?![0-9])|(?<![0-9][.,]))", " ")
    return F.filter(F.split(pointless, rf"[^\p{{L}}\p{{M}}\p{{N}}{_SLOT}.,]+", -1), lambda word: word != "")


def _is_slot(word: Column, kind: str = "") -> Column:
    return F.startswith(word, F.lit(_SLOT + kind))


def _value(word: Column) -> Column:
    """What a word says, in a slot or not."""
    return F.when(_is_slot(word), F.substr(word, F.lit(3))).otherwise(word)


def _typed(word: Column) -> Column:
    return F.when(_is_slot(word), F.substring(word, 1, 2)).otherwise(word)


def _named(word: Column) -> Column:
    """Names as plain words, other slots by their type."""
    return F.when(_is_slot(word, "p"), _value(word)).otherwise(_typed(word))


def _windows(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """``texts`` (with ``words``) as a row per window of these sizes: hash and place.

    Windows of different sizes have different hashes. A window with a name comes twice, with typed and
    with plain names. The array columns are made one by one, so that none is computed twice.
    """
    kept = [c for c in texts.columns if c != "words"]
    none = F.array().cast("array<struct<hash:bigint,place:int>>")

    def hashes(form) -> Column:
        return F.transform("words", lambda w: F.xxhash64(form(w)))

    def around(names: str, size: int) -> Column:
        """Where windows of this size begin that hold a name."""
        last = F.size("words") - size
        return F.array_distinct(F.flatten(F.transform(names, lambda p: F.sequence(
            F.greatest(p - size + 1, F.lit(0)), F.least(p, last)))))

    def windows(hashed: str, size: int, starts: Column | None = None) -> Column:
        starts = F.sequence(F.lit(0), F.size("words") - size) if starts is None else starts
        return F.when(F.size(hashed) >= size, F.transform(starts, lambda i: F.struct(
            F.xxhash64(F.slice(hashed, i + 1, size)).alias("hash"), i.alias("place")))).otherwise(none)

    whole, literal = [s for s in sizes if s >= LITERAL], [s for s in sizes if s < LITERAL]
    found, hashed = [], texts
    if whole:
        held = F.exists("words", lambda w: _is_slot(w, "p"))
        places = F.filter(F.transform("words", lambda w, i: F.when(_is_slot(w, "p"), i)), lambda i: i.isNotNull())
        hashed = hashed.withColumn("typed", hashes(_typed)).withColumn("names", F.when(held, places)).withColumn(
            "plain", F.when(F.col("names").isNotNull(), hashes(_named)))
        found += [windows("typed", size) for size in whole]
        found += [windows("plain", size, around("names", size)) for size in whole]
    if literal:
        hashed = hashed.withColumn("literal", hashes(_value))
        found += [windows("literal", size) for size in literal]
    made = hashed.select(*kept, F.explode(F.concat(none, *found)).alias("window"))
    return made.select(*kept, "window.hash", "window.place")


def _items(benchmark: DataFrame, rules: Templates) -> tuple[DataFrame, DataFrame]:
    """(item, words, n, size) of the different items, and (item_id, item) of all rows.

    ``size`` is the window that finds the item, also if one of its words is edited.
    """
    given = keep(benchmark.select("item_id", template_words(F.col("text")).alias("words"))
                 .where(F.size("words") > 0).distinct(), "benchmark-words")
    n = F.size("words")
    size = F.when(n < rules.least, n).when(n < 2 * rules.window, rules.short).otherwise(rules.window)
    items = keep(given.select("words").distinct().select(
        F.monotonically_increasing_id().alias("item"), "words", n.alias("n"), size.alias("size")),
        "benchmark-items")
    return items, given.join(items, "words").select("item_id", "item")


def _index(items: DataFrame, sizes: list[int], rules: Templates) -> tuple[DataFrame, DataFrame]:
    """(hash, laid, laid_place, n): the windows that lay items beside a document, and (laid, item, words, n).

    An item's windows that at most ``shared`` items have lay it as itself, or all if it has no such.
    Its other windows lay its class, all items that have the same of them at the same places. Numbers of
    classes are below 0; ``n`` is the number of words of a class's longest item.
    """
    windows = keep(reduce(DataFrame.unionByName, [
        _windows(items.where(F.col("size") == size).select("item", "n", "words"), [size]).distinct()
        for size in sizes]), "benchmark-windows")
    held = windows.groupBy("hash").agg((F.count_distinct("item") <= rules.shared).alias("own"))
    marked = keep(windows.join(held, "hash"), "benchmark-shared")
    without = marked.groupBy("item").agg(F.max("own").alias("any")).where(~F.col("any"))
    single = marked.join(without, "item", "left").where("own OR any IS NOT NULL").select(
        "hash", F.col("item").alias("laid"), F.col("place").alias("laid_place"), "n")
    prompts = keep(marked.where("NOT own").join(without, "item", "left_anti").groupBy("item", "n").agg(
        F.array_sort(F.collect_set(F.struct("hash", F.col("place").alias("laid_place")))).alias("marks")),
        "benchmark-prompts")
    classes = keep(prompts.groupBy("marks").agg((-1 - F.min("item")).alias("laid"), F.max("n").alias("n")),
                   "benchmark-classes")
    index = single.unionByName(classes.select("laid", "n", F.explode("marks").alias("mark")).select(
        "mark.*", "laid", "n"))
    members = prompts.select("item", "marks").join(classes.select("marks", "laid"), "marks").drop("marks").join(
        items, "item")
    laid_items = items.withColumn("laid", F.col("item")).unionByName(members)
    return index, laid_items.select("laid", "item", "words", "n")


def _identity() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _longest(places: Column) -> Column:
    """The most consecutive numbers in a sorted array of different ones."""
    none = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(held: Column, place: Column) -> Column:
        run = F.when(place == held["last"] + 1, held["run"] + 1).otherwise(1)
        return F.struct(place.alias("last"), run.alias("run"), F.greatest(held["best"], run).alias("best"))

    return F.aggregate(places, none, step, lambda held: held["best"])


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast a table of small rows if it is counted to be small, else leave it to Spark."""
    return F.broadcast(df) if df.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else df


def _same_text(a: str, b: str) -> Column:
    return (F.col(f"{a}.text_id") == F.col(f"{b}.text_id")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))


def _laid(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """doc_id, text_id, laid, shift, first and given: the words of a document around each place
    where an item or class is laid. ``given`` starts at word ``first`` of the document."""
    ids = candidates.select("doc_id", "text_id").distinct()
    texts = docs.alias("d").join(_bounded(ids).alias("i"), _same_text("d", "i"), "left_semi")
    places = candidates.groupBy("doc_id", "text_id").agg(
        F.collect_set(F.struct("laid", "shift", "n")).alias("places"))
    once = texts.groupBy("doc_id", "text_id").agg(F.first("text").alias("text"))
    words = once.alias("d").join(places.alias("p"), _same_text("d", "p")).select(
        "d.doc_id", "d.text_id", "p.places", template_words(F.col("d.text")).alias("words"))

    def around(p: Column) -> Column:
        first = F.greatest(p["shift"] - 1, F.lit(0))
        return F.struct(p["laid"].alias("laid"), p["shift"].alias("shift"), first.alias("first"),
                        F.slice("words", first + 1, p["n"] + 2).alias("given"))

    cut = words.select("doc_id", "text_id", F.size("words").alias("doc_words"),
                       F.transform("places", around).alias("places"))
    return cut.select("doc_id", "text_id", F.explode("places").alias("p")).select("doc_id", "text_id", "p.*")


def _compared(laid: DataFrame, items: DataFrame, rules: Templates) -> DataFrame:
    """The places where enough of an item is found, with consistent slots."""
    def at(i: Column, moved: int) -> Column:
        return F.get("given", i + F.col("shift") + moved - F.col("first"))

    def says(a: Column, b: Column) -> Column:
        return F.coalesce(_value(a) == _value(b), F.lit(False))

    def same_slot(a: Column, b: Column) -> Column:
        return F.coalesce(_is_slot(a) & (F.substring(a, 1, 2) == F.substring(b, 1, 2)), F.lit(False))

    def compare(i: Column) -> Column:
        asked = F.element_at("words", i + 1)
        slot = same_slot(asked, at(i, 0)) & (F.col("n") >= LITERAL)
        here = slot | says(asked, at(i, 0))
        return F.struct(i.alias("place"), slot.alias("slot"), here.alias("here"),
                        (here | says(asked, at(i, -1)) | says(asked, at(i, 1))).alias("near"),
                        _value(asked).alias("asked"), _value(at(i, 0)).alias("given"))

    compared = laid.join(items, "laid").withColumn(
        "at", F.transform(F.sequence(F.lit(0), F.col("n") - 1), compare))
    measured = compared.select(
        "doc_id", "text_id", "item", "n",
        F.size(F.filter("at", lambda w: w["near"])).alias("n_words"),
        _longest(F.transform(F.filter("at", lambda w: w["here"]), lambda w: w["place"])).alias("in_a_row"),
        F.array_distinct(F.transform(F.filter("at", lambda w: w["slot"]), lambda w: F.struct(
            w["asked"].alias("asked"), w["given"].alias("given")))).alias("filled"))
    asked = F.array_distinct(F.transform("filled", lambda p: p["asked"]))
    held = F.filter(asked, lambda q: F.size(F.filter("filled", lambda p: p["asked"] == q)) == 1)
    n = F.col("n")
    needed = F.when(n < rules.least, n).otherwise(F.greatest(
        F.ceil(rules.coverage * n), F.least(n - 1, F.lit(rules.least))))
    return measured.where(
        (F.size(held) >= rules.consistency * F.size(asked))
        & ((F.col("n_words") >= needed) | (F.col("in_a_row") >= rules.run))
    ).withColumn("changed", F.exists("filled", lambda p: p["asked"] != p["given"]))


def _leaks(docs: DataFrame, benchmark: DataFrame, rules: Templates) -> tuple[DataFrame, DataFrame]:
    """The leaks of each different item, and the ids of items."""
    items, names = _items(benchmark, rules)
    sizes = sorted(row["size"] for row in items.select("size").distinct().collect())
    texts = docs.select("doc_id", _identity().alias("text_id"), "text")
    if not sizes:
        return texts.where(F.lit(False)).select(
            "doc_id", "text_id", F.lit(0).cast("long").alias("item"), F.lit(0).alias("n"),
            F.lit(0).alias("n_words"), F.lit(False).alias("changed")), names
    index, laid_items = _index(items, sizes, rules)
    index = keep(index, "benchmark-index")
    windows = _windows(texts.select("doc_id", "text_id", template_words(F.col("text")).alias("words")), sizes)
    places = keep(windows.join(_bounded(index), "hash").select(
        "doc_id", "text_id", "laid", (F.col("place") - F.col("laid_place")).alias("shift"), "n").distinct(),
        "places")
    candidates = keep(places.where("laid >= 0"), "candidates").unionByName(places.where("laid < 0"))
    found = _compared(_laid(texts, candidates), keep(laid_items, "benchmark-laid"), rules)
    return keep(found.groupBy("doc_id", "text_id", "item", "n").agg(
        F.max("n_words").alias("n_words"), F.max("changed").alias("changed")), "leaks"), names


def find_leaks(docs: DataFrame, benchmark: DataFrame, rules: Templates = Templates()) -> DataFrame:
    """Benchmark items (item_id, text) that texts of ``docs`` (doc_id, text) hold.

    Gives a row per document and item it holds: doc_id, item_id, n_words (of the item, found in
    their place or one beside it), item_words and changed (some number, unit or name differs).
    Texts and items without words match nothing; an item of less than ``least`` words is found
    as a whole, of one or two words only with its own numbers and names. Repeated rows give one
    result, a NULL id is an id; without documents or items the result is empty. Other columns
    are not read.
    """
    leaks, names = _leaks(docs, benchmark, rules)
    return leaks.join(names, "item").groupBy("doc_id", "item_id").agg(
        F.max("n_words").alias("n_words"), F.max("n").alias("item_words"), F.max("changed").alias("changed"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, rules: Templates = Templates()) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; all columns stay."""
    leaks, _ = _leaks(docs, benchmark, rules)
    leaked = leaks.select(F.col("doc_id").alias("leaked_id"), F.col("text_id").alias("leaked_text")).distinct()
    return docs.join(leaked, F.col("doc_id").eqNullSafe(F.col("leaked_id"))
                     & (_identity() == F.col("leaked_text")), "left_anti")
