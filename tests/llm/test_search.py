"""Ranked search against scoring every document by itself."""

import math
import random
import re
from collections import Counter

import numpy as np
from odd import documents, no_documents, odd_documents, with_clashes

from cartwheel.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, best=10):
    """(item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text) pairs."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, bag, sum(bag.values())) for i, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    found = set()
    for item_id, text in items:
        scored = []
        for place, (doc_id, bag, n) in enumerate(bags):
            m = 10 + (90 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, place, doc_id))
        found |= {(item_id, k, hit[4], -hit[0]) for k, hit in enumerate(sorted(scored)[:best], 1)}
    return found


def check(spark, texts, items, **kw):
    frame = spark.createDataFrame(items, ITEMS)
    found = [tuple(r) for r in search.search(documents(spark, *texts), frame, **kw).select(
        "item_id", "rank", "doc_id", "score").collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(list(enumerate(texts)), items, **kw)
    return found


def random_texts(seed, n, words=40):
    chosen = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["Über", "日本", "ÄB", "x1"]
    return [" ".join(chosen.choices(vocabulary, k=chosen.randint(0, 14))) for _ in range(n)]


def test_search_equals_scoring_each_document(spark):
    texts = random_texts(1, 300) + ["W1 w2, W3!"] * 40 + [None, "", " -- ", "w1 w1 w1 w1", "über Über"]
    items = list(enumerate(random_texts(2, 12) + ["w1 W1 w2", "nowhere", "--", None, "Über äB"]))
    check(spark, texts, items)
    check(spark, texts, items, best=3)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 12)
    monkeypatch.setattr(search, "SCORES_AT_ONCE", 7)
    check(spark, random_texts(3, 120), list(enumerate(random_texts(4, 9))))


def test_a_class_of_equal_bags_gives_its_smallest_ids(spark):
    texts = ["rare other words"] + ["same bag here"] * 500 + ["here, same BAG!"] * 20
    found = check(spark, texts, [(1, "bag"), (2, "rare bag")])
    assert sorted(d for i, _, d, _ in found if i == 1) == list(range(1, 11))


def test_classes_are_told_apart_by_the_bag(spark):
    bags = search.keep(search._bags(documents(spark, *random_texts(5, 200)), sorted({b"w1", b"w2", b"w3"})), "bags")
    classes = search._classes(bags, search._length_part("n", 200, 1400), 10).collect()
    rows = [r for r in bags.collect() if len(r.bag)]
    expected = {}
    for r in rows:
        expected.setdefault((bytes(r.bag), 10 + (90 * r.n * 200) // 1400), []).append(r.doc_id)
    assert {(bytes(c.bag), c.m): c.members for c in classes} == {k: sorted(v)[:10] for k, v in expected.items()}


def test_scores_are_whole_numbers(monkeypatch):
    block = search.Block([b"a", b"b"], np.array([5, 6]), np.array([0, 0, 1]), np.array([0, 1, 1]))
    postings = search.postings_of(block, np.array([30_000, 29_999]))
    bag = np.array([[0, 2_000_000_000], [1, 3]], dtype=np.int32).tobytes()
    only = np.array([[1, 1]], dtype=np.int32).tobytes()
    part = [[(10**9 * tf) // (1000 * tf + 8 * m) for tf in (2_000_000_000, 3)] for m in (10, 10**12)]
    expected = [[30_000 * a + 29_999 * b, 29_999 * b] for a, b in part] + [[29_999 * (10**9 // 1080)] * 2]
    for at_once in (2_000_000, 2, 1):
        monkeypatch.setattr(search, "SCORES_AT_ONCE", at_once)
        assert search.scores_of([bag, bag, only], np.array([10, 10**12, 10]), postings).tolist() == expected


def test_search_of_odd_rows(spark):
    items = with_clashes(spark.createDataFrame(
        [(1, "rain in the north"), (1, "rain in the north"), (None, "Regen"), (2, None), (3, "the")], ITEMS))
    found = {tuple(r) for r in search.search(odd_documents(spark), items).select("item_id", "rank", "doc_id", "score").collect()}
    from odd import ROWS
    docs = [(r[0], r[1]) for r in ROWS]
    assert found == brute(docs, [(1, "rain in the north"), (None, "Regen"), (3, "the")])
    assert {(None, 1, None)} <= {r[:3] for r in found}
    assert search.search(no_documents(spark), items).count() == 0
    assert search.search(odd_documents(spark), items.limit(0)).count() == 0
