"""Operators that compare documents with each other: 1, 4, 7 and 9, and the pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from odd import EXPECTED_COUNTS, WORD, count_by, documents, no_documents, odd_documents, results, with_clashes

import corpus_pipeline
from cartwheel.llm import decontam, mixing, neardup, suffixes

FOLDER = "/root/testdata/sf0.001"


def words(random_, n):
    return [".".join(random_.choices("abcdefgh", k=random_.randint(1, 5))) for _ in range(n)]


def variants(seed, groups, copies, size=60):
    """Groups of texts that differ from a base in some words, and their exact copies."""
    r = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = words(r, size)
        for _ in range(copies):
            text = list(base)
            for _ in range(r.randint(0, 4)):
                text[r.randrange(size)] = words(r, 1)[0].upper()
            texts.append(" ".join(text))
    return texts


# --- near duplicates -----------------------------------------------------

def shingles(text, size=4):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(found) < size:
        return frozenset([tuple(found)] if found else [])
    return frozenset(zip(*(found[k:] for k in range(size))))


def brute_components(docs, size=4):
    sets = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def found_components(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


TEXTS = variants(3, 6, 14) + ["a b c", "A B C", "a b", "", " ", "x", "X", "a b c d", "É b c d e", "é b c d e"]


@pytest.mark.parametrize("limits", [
    {}, {"CLUSTER_NODES": 3}, {"CLUSTER_NODES": 3, "PAIRED_NODES": 2, "BLOCK_NODES": 4},
    {"CLUSTER_NODES": 3, "LINKS_PER_TASK": 2}, {"LINKS_PER_TASK": 3},
])
def test_components_by_every_path(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(neardup, name, value)
    docs = documents(spark, *TEXTS, first=100)
    expected = brute_components([(i, t) for i, t in enumerate(TEXTS, 100)])
    assert found_components(neardup.near_duplicates(docs)) == expected


def test_components_of_a_chain(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (7, 7)], "a long, b long")
    expected = {i: 0 for i in range(41)} | {100: 90, 90: 90}
    for most in (500_000, 5):
        monkeypatch.setattr(neardup, "LINKS_PER_TASK", most)
        assert {r.node: r.root for r in neardup.components(links).collect()} == expected


def test_near_duplicates_of_odd_rows(spark):
    found = neardup.near_duplicates(odd_documents(spark))
    assert count_by(found) == EXPECTED_COUNTS
    rows = results(found)
    assert rows[2]["n_shingles"] == 0 and rows[2]["component_id"] == 2 and rows[2]["kept"]
    assert neardup.near_duplicates(no_documents(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = odd_documents(spark)
    kept = neardup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert count_by(kept) == EXPECTED_COUNTS | {1: 1}
    texts = documents(spark, *TEXTS)
    expected = {i for i, (n, _, first) in brute_components(list(enumerate(TEXTS))).items() if first}
    assert set(results(neardup.without_near_duplicates(texts))) == expected
    same_id = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p"), (1, "A b c d e f g h i j k l m n o p")],
                                    "doc_id long, text string")
    assert neardup.without_near_duplicates(same_id).count() == 1
    assert neardup.without_near_duplicates(no_documents(spark)).count() == 0


# --- repeated strings ----------------------------------------------------

def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    found = []
    for (key, _), t in zip(rows, texts):
        covered = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p:p + length]] > 1:
                covered[p:p + length] = b"\1" * length
        kept = bytes(b for b, c in zip(t, covered) if not c)
        spans = len(re.findall(b"\1+", bytes(covered)))
        found.append((key, len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(found)


@pytest.mark.parametrize("compared", [64, 2])
def test_repeats(spark, monkeypatch, compared):
    monkeypatch.setattr(suffixes, "COMPARED", compared)
    r = random.Random(9)
    base = [words(r, 90) for _ in range(3)]
    rows = []
    for i in range(60):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            text[r.randrange(len(text))] = words(r, 1)[0]
        start = r.randint(0, 40)
        cut = words(r, r.randint(0, 30)) + text[start:start + r.randint(30, 90)] + words(r, r.randint(0, 30))
        rows.append((i, " ".join(cut)))
    rows += [(70, "a" * 700), (71, "a" * 199), (72, "é" * 100), (73, "ab" * 200), (74, "c" * 200), (75, "c" * 201),
             (76, "x" * 200), (77, ""), (78, rows[0][1]), (79, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffixes.remove_repeats(docs)
    assert Counter(map(tuple, got.collect())) == brute_repeats(rows, 200)


def test_repeats_across_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", 300)
    texts = variants(4, 2, 6, size=300) + ["short", "x" * 200]
    rows = list(enumerate(texts))
    text, _, _, first, place, last = suffixes.runs_of([t.encode() for t in texts])
    for i, t in enumerate(texts):  # every window is in one run, in order
        runs = [(a, b) for k, a, b in zip(text, first, last) if k == i]
        assert [p for a, b in runs for p in range(a, b + 1)] == list(range(len(t.encode()) - 199))
    assert ((first <= place) & (place <= last + 136)).all()
    found = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, found.collect())) == brute_repeats(rows, 200)


def test_repeats_of_odd_rows(spark):
    found = suffixes.remove_repeats(odd_documents(spark))
    assert count_by(found) == EXPECTED_COUNTS
    rows = results(found)
    assert rows[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest() and rows[2]["n_removed"] == 0
    assert rows[1]["n_removed"] == 0 and rows[5]["n_removed"] == rows[5]["n_bytes"]
    assert suffixes.remove_repeats(no_documents(spark)).count() == 0


# --- decontamination -----------------------------------------------------

ITEMS = "item_id long, text string"
QUESTION = "Tom has 3 apples and Tom gives 3 kg of them to Ann before 12 of them go bad today."


def test_reparameterised_question(spark):
    items = spark.createDataFrame([(1, QUESTION), (2, "too short"), (3, None), (4, "")], ITEMS)
    changed = QUESTION.replace("3", "7").replace("Ann", "Sue").replace("12", "40")
    docs = documents(
        spark, "Look: " + changed + " Indeed", changed.replace("7 kg", "9 kg"), QUESTION + " " + QUESTION,
        QUESTION[:30], "Too short!", "too short here", None, changed.replace("kg", "apples"))
    found = {(r.doc_id, r.item_id): r.changed for r in decontam.find_leaks(docs, items).collect()}
    assert found == {(0, 1): True, (2, 1): False, (4, 2): False, (5, 2): False, (7, 1): True}


def test_whole_passages_are_found(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))

    def plain(text):
        return " ".join(re.findall(r"[^\W\d_]+", text.lower()))

    questions = [(r.item_id, plain(r.text)) for r in items.collect()]
    expected = {(d.doc_id, i) for d in docs.collect() for i, q in questions if q in plain(d.text or "")}
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()}
    assert expected <= found and len(found) <= len(expected) + 1 and expected
    left = set(results(decontam.remove_leaks(docs, items)))
    assert left == set(results(docs)) - {d for d, _ in found}


def test_leaks_by_shuffled_join(spark, monkeypatch):
    docs = documents(spark, QUESTION, "nothing here")
    items = spark.createDataFrame([(1, QUESTION)], ITEMS)
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert [(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, items).collect()] == [(0, 1)]


def test_leaks_of_odd_rows(spark):
    docs = odd_documents(spark)
    items = with_clashes(spark.createDataFrame(
        [(1, "The rain in the north was heavy and the men went home before dark."), (None, QUESTION), (3, None)], ITEMS))
    assert {r.doc_id for r in decontam.find_leaks(docs, items).collect()} == {1}
    left = decontam.remove_leaks(docs, items)
    assert left.columns == docs.columns
    assert count_by(left) == {k: n for k, n in EXPECTED_COUNTS.items() if k != 1}
    assert decontam.find_leaks(no_documents(spark), items).count() == 0
    assert count_by(decontam.remove_leaks(docs, items.limit(0))) == EXPECTED_COUNTS


# --- mixing --------------------------------------------------------------

def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    """Share by weight; who has more than the most stops there, and the rest is shared anew."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    found, open_, left = [0.0] * len(sizes), set(range(len(sizes))), share * sum(sizes)
    while open_:
        total = sum(weight[i] for i in open_)
        full = [i for i in open_ if left * weight[i] / total > most * sizes[i]]
        if not full:
            for i in open_:
                found[i] = left * weight[i] / total
            break
        for i in full:
            found[i] = most * sizes[i]
            open_.discard(i)
        left -= sum(found[i] for i in full)
    return found


def test_targets():
    assert plain_targets([10, 10, 10]) == [20.0, pytest.approx(50 / 3), pytest.approx(25 / 3)]
    got = plain_targets([10, 100, 1000, 0])
    assert sum(got) == pytest.approx(1.5 * 1110) and got[0] == 20 and got[3] == 0
    assert all(t <= 2 * s for t, s in zip(got, [10, 100, 1000, 0]))
    assert plain_targets([]) == []


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_planned_sources(spark, seed):
    r = random.Random(seed)
    sizes = [r.choice([0, 1, 7, 64, 1000, 10 ** r.randint(1, 9)]) for _ in range(r.choice([1, 5, 60]))]
    names = sorted({"".join(r.choices("aZé日\U0001F600", k=4)) for _ in range(900)}, key=str.encode)[:len(sizes) - 1] + [None]
    rows = [(n, s) for n, s in zip(names, sizes)]
    plan = mixing.planned_sources(spark.createDataFrame(rows, "source string, size long")).orderBy("number").collect()
    assert [(p.source, p.source_size) for p in plan] == rows and [p.number for p in plan] == list(range(len(rows)))
    assert [p.target for p in plan] == pytest.approx(plain_targets(sizes))
    assert all(p.blocks == -(-p.source_size // 64) and p.slots <= 2 * p.blocks for p in plan)
    assert all(abs(p.slots * p.source_size / max(p.blocks, 1) - p.target) <= 64 for p in plan)


def permuted(spark, size, indexes):
    from pyspark.sql import functions as F
    n = F.lit(size).cast("long")
    frame = spark.createDataFrame([(i,) for i in indexes], "i long").withColumn("rounds", mixing._rounds(n, F.lit(5), F.lit(0)))
    return [r.p for r in frame.select(mixing._permuted(F.col("i"), n, F.col("rounds")).alias("p")).collect()]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1024, 30030])
def test_permutation(spark, size):
    assert sorted(permuted(spark, size, range(size))) == list(range(size))


@pytest.mark.parametrize("size", [2**33 + 1, 2**38, 2**45, 2**45 - 17, 2**46 * 3 // 2])
def test_permutation_of_large_sources(spark, size):
    """As in whole numbers of any length, and undone step by step."""
    from pyspark.sql import functions as F
    r = random.Random(size)
    indexes = [0, 1, size - 1, size // 2] + [r.randrange(size) for _ in range(200)]
    found = permuted(spark, size, indexes)
    rounds = spark.range(1).select(mixing._rounds(F.lit(size).cast("long"), F.lit(5), F.lit(0)).alias("r")).first().r
    upper = (size + 1) // 2
    assert all(1 < t.factor <= 2**62 // size for t in rounds)
    for index, place in zip(indexes, found):
        assert 0 <= place < size
        for turn in reversed(rounds):
            y = 2 * place if place < upper else 2 * (place - upper) + 1
            place = (y - turn.offset) * pow(turn.factor, -1, size) % size
        assert place == index
    assert sum(p > size // 2 for p in found) > 50


def test_shards_draw_their_sources(spark):
    sized = spark.createDataFrame([(s, 64 * n) for s, n in (("a", 3000), ("b", 9000), ("c", 500))], "source string, size long")
    mix = mixing.Mix(shard_slots=500)
    plan = mixing.planned_sources(sized, mix)
    drawn = mixing.drawn_blocks(plan, mix)
    slots = {p.number: (p.slots, p.blocks) for p in plan.collect()}
    rows = drawn.collect()
    for number, (n, blocks) in slots.items():
        own = Counter(r.block for r in rows if r.number == number)
        assert sum(own.values()) == n and max(own) < blocks
        assert {*own.values()} <= {n // blocks, n // blocks + 1}
    total = sum(n for n, _ in slots.values())
    per_shard = Counter(r.shard for r in rows)
    assert len(per_shard) == -(-total // 500) and all(350 < n < 650 for n in per_shard.values())
    share = Counter((r.shard, r.number) for r in rows)
    for number, (n, _) in slots.items():
        spread = [share[shard, number] - n / len(per_shard) for shard in per_shard]
        assert any(abs(d) > 1 for d in spread)  # drawn, not dealt out evenly
        assert all(abs(d) < 6 * (n / len(per_shard)) ** 0.5 + 6 for d in spread)


def test_many_sources_and_copies(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(mixing, "LAID_ROWS", 50)
    monkeypatch.setattr(mixing, "COPIES_PER_TASK", 16)
    monkeypatch.setattr(mixing, "SLOTS_PER_TASK", 64)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 10)
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('w ', CAST(id % 90 AS INT)) AS text", "concat('s', id % 137) AS source")
    docs = docs.unionByName(spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.lit("one two three").alias("text"),
                                                    F.lit("s1").alias("source")))
    sizes = [(r.doc_id, r.source, len((r.text or "").split())) for r in docs.collect()]
    rows = mixing.mix_sources(docs, mixing.Mix(block=4)).collect()
    taken, wanted = check_mix(rows, sizes)
    assert all(abs(taken[s] - t) <= 8 for s, t in wanted.items())
    assert len({r.taken for r in rows if r.doc_id == 7}) > 1  # copies are taken each for itself


def check_mix(rows, sizes):
    by_source = defaultdict(lambda: [0, 0, None])
    for doc_id, source, size in sizes:
        by_source[source][0] += size
    names = sorted(by_source, key=lambda s: (s is None, (s or "").encode()))
    wanted = dict(zip(names, plain_targets([by_source[s][0] for s in names])))
    taken = Counter()
    assert len(rows) == len(sizes)
    pool = defaultdict(list)
    for r in rows:
        pool[(r.doc_id, r.size)].append(r)
    for doc_id, source, size in sizes:
        row = pool[(doc_id, size)].pop()
        assert row.source_size == by_source[source][0] and row.target == pytest.approx(wanted[source])
        assert 0 <= row.taken <= 2 * row.size
        taken[source] += row.taken
    return taken, wanted


def test_mix_meets_targets(spark):
    r = random.Random(1)
    data = [(i, " ".join(["w"] * r.randint(0, 400)), f"s{r.choice('0001234')}") for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    mix = mixing.Mix(block=16, shard_slots=300)
    rows = mixing.mix_sources(docs, mix).collect()
    taken, wanted = check_mix(rows, [(i, s, len(t.split())) for i, t, s in data])
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 0.02 * target + 4 * mix.block
    again = mixing.mix_sources(docs.repartition(7), mix).collect()
    assert sorted((x.doc_id, x.taken) for x in rows) == sorted((x.doc_id, x.taken) for x in again)


def test_mix_of_odd_rows(spark):
    docs = odd_documents(spark)
    found = mixing.mix_sources(docs)
    assert count_by(found) == EXPECTED_COUNTS
    sizes = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    check_mix(found.collect(), sizes)
    assert results(found)[3]["size"] == results(found)[3]["taken"] == 0
    assert mixing.mix_sources(no_documents(spark)).count() == 0


# --- pipeline ------------------------------------------------------------

def test_pipeline_equals_its_parts(spark):
    """Each stage against plain versions of what its operator decides."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = results(rows)
        rows = stage(spark, rows, FOLDER)
        assert rows.columns == docs.columns
        after = results(rows)
        assert set(after) <= set(before)
        if name == "language_id":
            assert set(after) == {k for k, r in before.items() if any(c.isalpha() for c in r["text"] or "")}
        elif name == "near_dedup":
            found = brute_components([(k, r["text"]) for k, r in before.items()], 5)
            assert set(after) == {k for k, (n, _, first) in found.items() if first}
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert all(r["text"] == before[k]["text"] or "[SECRET]" in r["text"] for k, r in after.items())
        rows = spark.createDataFrame(rows.collect(), rows.schema)
    mixed = corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).collect()
    check_mix(mixed, [(r.doc_id, r.source, len(WORD.findall(r.text))) for r in rows.collect()])
    whole = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.taken) for r in whole) == sorted((r.doc_id, r.taken) for r in mixed)


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_take_odd_rows(spark, stage):
    assert stage[1](spark, odd_documents(spark), FOLDER).count() <= sum(EXPECTED_COUNTS.values())
    assert stage[1](spark, no_documents(spark), FOLDER).count() == 0
