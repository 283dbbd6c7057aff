"""Language samples of any ids and labels, and the two-step vote against a plain version."""

import math
from collections import Counter

import numpy as np
import pytest
from odd import results
from pyspark.sql import functions as F

from cartwheel.llm import chat, language

FOLDER = "/root/testdata/sf0.001"
WORDS = {"en": "the rain and the men went home before dark", "de": "der regen und die leute gingen nach hause",
         "fr": "la pluie et les hommes sont rentres avant la nuit"}


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_rows_of_one_id(spark):
    rows = [(1, f"{WORDS[lang]} {k}", lang) for k in range(170) for lang in WORDS]
    found = language.identify(labelled(spark, rows))
    assert found.count() == 510
    assert found.select("lang_pred").distinct().count() == 3


def test_copies_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "FIT_ROWS_PER_LANGUAGE", 20)
    rows = [(1, WORDS["en"], "en")] * 3000 + [(k, f"{WORDS[lang]} {k}", lang) for k in range(8, 200) for lang in WORDS]
    usable = labelled(spark, rows)
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    sample = language._lowest(usable, counts, 20).collect()
    assert Counter(r.lang for r in sample) == {"en": 20, "de": 20, "fr": 20}
    hashes = {lang: sorted(r.h for r in usable.where(F.col("lang") == lang).select(
        F.pmod(F.xxhash64(F.lit("fit"), "doc_id", "text"), F.lit(1 << 30)).alias("h")).distinct().collect()) for lang in WORDS}
    assert all(sorted(r.draw for r in sample if r.lang == lang) == hashes[lang][:20] for lang in WORDS)


def test_more_labels_than_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 12)
    rows = [(k, f"{WORDS['en']} {k % 300} {'xyzw'[k % 4] * 9}", f"l{k % 300:03}") for k in range(900)]
    rows += [(k, f"{WORDS['de']} {k}", "de") for k in range(900, 960)]
    found = language.identify(labelled(spark, rows))
    assert found.count() == 960
    names = {r.lang_pred for r in found.select("lang_pred").distinct().collect()}
    assert "de" in names and names <= {"de", *(f"l{k:03}" for k in range(300))}


@pytest.mark.parametrize("most, rows", [(200, 3200), (4, 3200), (4, 8)])
def test_every_label_is_learned(spark, monkeypatch, most, rows):
    """Also with more labels than families that vote one against one, and than rows of the sample."""
    monkeypatch.setattr(language, "MAX_LANGUAGES", most)
    monkeypatch.setattr(language, "FIT_ROWS", rows)
    labels = {f"q{k:02}": [c + v + d for c in "bcdfg" for v in "aeiou"[k % 5] for d in "klmnprstvwxyz"[k % 13] + "hj"[k // 13]]
              for k in range(21)}
    docs = [(100 * k + n, " ".join(words[n % 5:] + words), name) for k, (name, words) in enumerate(labels.items())
            for n in range(12 + k)]
    table = labelled(spark, docs)
    found = {r.doc_id: r.lang_pred for r in language.identify(table).collect()}
    assert found == {doc_id: name for doc_id, _, name in docs}
    kept = language.accept(table).groupBy("lang").count().collect()
    assert {r.lang for r in kept} == set(labels)


def plain_features(text):
    """Counts of hashed n-grams of 2, 3 and 4 folded bytes at each place."""
    folded = [ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else 32 if b < 128 else b for b in text]
    data = [32] * 3 + folded + [32] * 4
    found = Counter()
    for at in range(len(text) + 4):
        for n in (2, 3, 4):
            code = 0
            for b in data[at:at + n]:
                code = (code << 8 | b) % 2**32
            mixed = code * 2654435761 % 2**32
            found[(mixed ^ mixed >> 15) * 2246822519 % 2**32 >> 20] += 1
    return found, len(text) + 4


def plain_vote(names, machines, features, n):
    votes, sums, least = Counter(), Counter(), {name: math.inf for name in names}
    for m in machines:
        value = sum(float(m.weights[code]) * k for code, k in features.items()) / n + m.offset
        for name, own in ((m.first, value), (m.second, -value)):
            votes[name] += own > 0
            sums[name] += math.tanh(own)
            least[name] = min(least[name], own)
    best = max(names, key=lambda x: (votes[x] + sums[x] / (2 * len(names) + 1), -names.index(x)))
    return best, 1 / (1 + math.exp(-4 * min(max(least[best], -20), 20)))


def test_votes_equal_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.learn(docs)
    texts = [(r.text or "")[:300].encode() for r in docs.orderBy("doc_id").limit(60).collect()] + [b"a", b"a b c", b"12 .", b""]
    languages, scores = language.predict(model, texts)
    for text, lang, score in zip(texts, languages, scores):
        if not language.has_letter(text):
            assert (lang, score) == ("und", 0.0)
            continue
        features, n = plain_features(text)
        family, sure = plain_vote(list(model.members), model.between, features, n)
        inner, inner_sure = plain_vote(model.members[family], model.within[family], features, n)
        assert score == pytest.approx(min(sure, inner_sure), abs=1e-4)
        assert lang == inner or score == pytest.approx(0.5, abs=0.02)
        alone, own = language.predict(model, [text])
        assert own[0] == pytest.approx(score, abs=1e-6)  # whatever texts are beside it
    assert len(set(languages)) > 2 and np.mean(scores) > 0.5


def test_a_long_system_turn_goes_to_spans_with_turns(spark):
    turns = [(1, 0, "system", "s" * 300_000), (1, 1, "user", "hello"), (1, 2, "assistant", "yes"), (2, 0, "user", "x")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(frame, chat.Budget(64))
    assert windows.where("conv_id = 1").count() <= 3
    rows = results(chat.digests(windows), "conv_id")
    assert rows[1]["n_turns"] == 3 and rows[1]["loss_chars"] == 3
