"""Benchmark items are found wherever and however much of them a document holds."""

import math
import random
import re

import pytest
import regex
from odd import documents

from cartwheel.llm import decontam

ITEMS = "item_id long, text string"


def found(spark, items, *texts):
    items = spark.createDataFrame(list(enumerate(items)), ITEMS)
    return {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents(spark, *texts), items).collect()}


def test_short_items_inside_longer_texts(spark):
    items = ["What is 17 times 23 ?", "Name the longest river of Asia", "who knew"]
    around = "and then one of them asked what had been on all of our minds for days: "
    assert found(spark, items, around + items[0] + " Nobody could say.", around + "what is 4 times 5? " + items[1],
                 around + "What is times?", items[1][5:], "so what is 1 times 2", "Who knew?", around + "who  knew") == {
        (0, 0), (1, 0), (1, 1), (4, 0), (5, 2), (6, 2)}


def test_passages_of_long_items(spark):
    words = [a + b for a in "bcdfghjk" for b in ("alo", "emi", "ira", "ons", "uth", "elt", "arn", "ost")]
    item = words[:59]
    around = "nothing to see here at all on this day "
    parts = [item[10:35], item[10:22], item[10:23], item[:10] + ["other"] + item[11:21]]
    texts = [around + " ".join(part) + " and so it ends here" for part in parts]
    assert found(spark, [" ".join(item)], *texts) == {(0, 0), (2, 0)}


def test_units_and_white_space(spark):
    item = "the walk to Ann took 1 hour and then he ran on to Bea for 2 miles until dark"
    texts = [item.replace("1 hour", "2 hours"), item.replace("to ", "to\n"), item.replace(" Bea", "  Kim").replace("2 miles", "1 mile")]
    assert found(spark, [item], *texts) == {(0, 0), (1, 0), (2, 0)}


def test_copies_in_other_letters(spark):
    item = "On Monday we asked Anna and Bert to carry the boxes from Berlin over to the hall"
    texts = [item.lower(), item.upper(), item, item.replace("Anna", "Clara").replace("Bert", "Dora"),
             item.lower().replace("anna", "bert")]
    assert found(spark, [item], *texts) == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 0)}


def test_one_word_changed_in_short_items(spark):
    words = [a + b for a in "bcdfg" for b in ("alo", "emi", "ira", "ons", "uth")]
    items = [" ".join(words[:n]) for n in range(8, 23)]
    around = "nothing to see here at all "
    texts = []
    for item in items:
        own = item.split()
        own[len(own) // 2] = "zebra"
        texts.append(around + " ".join(own) + " and so on")
    hits = found(spark, items, *texts)
    assert {(k, k) for k in range(len(items))} <= hits
    inserted = [around + " ".join(i.split()[:len(i.split()) // 2] + ["zebra"] + i.split()[len(i.split()) // 2:]) for i in items]
    assert {(k, k) for k in range(len(items))} <= found(spark, items, *inserted)


def test_items_of_one_or_two_words_are_taken_literally(spark):
    assert found(spark, ["Xylophone", "17 kg", "Bob"], "my xylophone, broken", "it has 17 kg now", "it has 18 kg now",
                 "so bob said", "then Ann said") == {(0, 0), (1, 1), (3, 2)}


@pytest.mark.parametrize("run", [" ", "-", ".", ",", "\n", "\t", "1,", "a.", "1 ", "- ", "\u3000", "\u0301", "Aa "])
def test_long_runs_of_separators(spark, run):
    """A million characters, in the operator and in the pipeline's stage."""
    item = "the walk to the hill took all of them a whole day and then some"
    text = item + run * (1_000_000 // len(run)) + " " + item + " " + run * 3000
    assert found(spark, [item], text, run * 400_000) == {(0, 0)}


def test_a_prompt_of_many_items_gives_no_pairs(spark):
    prompt = "read the text below with care and then say it"
    words = [a + b + c for a in "bcdfghjk" for b in "aeiou" for c in ("lo", "mi", "ra", "ns", "th")]
    r = random.Random(3)
    items = [prompt + " " + " ".join(r.sample(words, 24)) for _ in range(60)]
    texts = [prompt + " " + " ".join(r.sample(words, 30)) for _ in range(50)] + [items[5], "x " + items[7].upper()]
    laid = []

    def keep(df, label, f=decontam.keep):
        kept = f(df, label)
        if label == "candidates":
            laid.append(kept.count())
        return kept

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(decontam, "keep", keep)
        assert found(spark, items, *texts) == {(50, 5), (51, 7)}
    assert laid[0] < 60  # not one for each of 50 texts and 60 items
    assert found(spark, [prompt] + items, texts[0]) == {(0, 0)}


def template(text):
    """template_words in Python."""
    text = re.sub("[\x01\t\n\r]", " ", text)
    text = re.sub(r"[0-9]+(?:[.,][0-9]+)*", lambda m: f" \x01n{m.group()} ", text)
    if "\x01" in text:
        units = "|".join(decontam.UNITS)
        text = regex.sub(rf"(\x01n[0-9.,]+) +(?i:({units}))(?![\p{{L}}\p{{N}}])", "\\1 \x01u\\2", text)
    text = regex.sub(r"(?<=[\p{Ll},;] {1,4})(\p{Lu}\p{Ll}+)", "\x01p\\1", text).lower()
    text = re.sub(r"[.,](?![0-9])|(?<![0-9])[.,]", " ", text)
    return [w for w in regex.split("[^\\p{L}\\p{M}\\p{N}\x01.,]+", text) if w]


def value(word):
    return word[2:] if word.startswith("\x01") else word


def brute_leaks(texts, items, rules=decontam.Templates()):
    """Every item laid at every place of every document that shares a window of its own."""
    parts = [template(i) for i in items]
    sizes = [len(w) if len(w) < rules.least else rules.short if len(w) < 2 * rules.window else rules.window for w in parts]

    def windows(words, size):
        forms = [[value(w) for w in words]] if size < decontam.LITERAL else [
            [w[:2] if w[0] == "\x01" else w for w in words],
            [value(w) if w[:2] == "\x01p" else w[:2] if w[0] == "\x01" else w for w in words]]
        return {(tuple(f[i:i + size]), i) for f in forms for i in range(len(words) - size + 1)}

    held = {}
    for words, size in {(tuple(w), s) for w, s in zip(parts, sizes) if w}:
        for window, _ in windows(words, size):
            held.setdefault(window, set()).add(words)
    leaks = set()
    for d, text in enumerate(texts):
        words = template(text)
        for k, (asked, size) in enumerate(zip(parts, sizes)):
            if not asked:
                continue
            own = windows(asked, size)
            rare = {(w, i) for w, i in own if len(held[w]) <= rules.shared} or own
            shifts = {j - i for v, j in windows(words, size) for w, i in rare if v == w}
            for shift in shifts:
                def at(i):
                    return words[i] if 0 <= i < len(words) else None
                here, near, filled = [], 0, set()
                for i, a in enumerate(asked):
                    b = at(i + shift)
                    slot = bool(b) and len(asked) >= decontam.LITERAL and a[0] == b[0] == "\x01" and a[1] == b[1]
                    if slot:
                        filled.add((value(a), value(b)))
                    here.append(slot or bool(b) and value(a) == value(b))
                    near += here[-1] or any(x and value(x) == value(a) for x in (at(i + shift - 1), at(i + shift + 1)))
                names = {a for a, _ in filled}
                single = sum(sum(x == a for x, _ in filled) == 1 for a in names)
                row = max(map(len, "".join("x" if h else " " for h in here).split()), default=0)
                n = len(asked)
                needed = n if n < rules.least else max(math.ceil(rules.coverage * n), min(n - 1, rules.least))
                if single >= rules.consistency * len(names) and (near >= needed or row >= rules.run):
                    leaks.add((d, k))
    return leaks


def test_leaks_equal_a_plain_matcher(spark):
    r = random.Random(11)
    words = ["the", "of", "Ann", "Bea", "and", "3", "12", "7 kg", "2 miles", "hill", "road", "ran", "to", "box", "4.5"]
    items = [" ".join(r.choices(words, k=r.choice([1, 2, 3, 5, 8, 9, 13, 16, 24, 40]))) for _ in range(60)]
    items += ["of the road " + i for i in items[:25]]
    texts = []
    for item in items:
        own = item.split()
        for _ in range(r.randint(0, 3)):
            own[r.randrange(len(own))] = r.choice(words)
        if r.random() < 0.3:
            own.insert(r.randrange(len(own)), "zebra")
        if r.random() < 0.2:
            own = [w.upper() for w in own]
        texts.append(" ".join(r.choices(words, k=r.randint(0, 20)) + own + r.choices(words, k=r.randint(0, 6))))
    expected = brute_leaks(texts, items)
    assert found(spark, items, *texts) == expected and len(expected) > 100


def test_items_that_share_a_prompt_are_all_found(spark):
    """Thirty items begin with the same fourteen words, and a text holds these alone or with a tail."""
    words = [a + b + c for a in "bcdfghjk" for b in "aeiou" for c in ("lo", "mi", "ra", "ns", "th")]
    prompt = words[:14]
    r = random.Random(5)
    tails = [r.sample(words[14:], 4 + k % 9) for k in range(30)]
    items = [" ".join(prompt + tail) for tail in tails]
    cut = [w for k, w in enumerate(prompt) if k != 7]
    texts = ["so it went " + " ".join(prompt) + " and no more", "then " + " ".join(prompt[:12]) + " alas",
             " ".join(cut + tails[3]), "nothing of it here"]
    hits = found(spark, items, *texts)
    assert hits == brute_leaks(texts, items, decontam.Templates(shared=1000))
    assert {k for d, k in hits if d == 0} == set(range(30)) and {d for d, _ in hits} == {0, 1, 2}


def test_the_pipeline_drops_documents_with_a_shared_prompt(spark):
    words = [a + b + c for a in "bcdfghjk" for b in "aeiou" for c in ("lo", "mi", "ra", "ns", "th")]
    items = [" ".join(words[:14] + words[20 + 4 * k:24 + 4 * k]) for k in range(25)]
    docs = documents(spark, "so it went " + " ".join(words[:14]) + " and no more", "then " + " ".join(words[:8]))
    left = decontam.remove_leaks(docs, spark.createDataFrame(list(enumerate(items)), ITEMS))
    assert [r.doc_id for r in left.collect()] == [1]
