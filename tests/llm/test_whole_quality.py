"""The quality ratio counts everything it is given, at any size."""

import math
import random
from collections import Counter

import pytest
from odd import documents, results
from pyspark.sql import functions as F

from cartwheel.llm import quality

LABELS = "doc_id long, quality int, toxic int"
TEXTS = ["the men went home before dark", "qx zv qq vz xx the", "the rain was heavy", "zv zv qx home"]


def repeated(spark, times):
    """TEXTS over and over; the first and third of every four are trusted."""
    texts = F.array(*map(F.lit, TEXTS))
    docs = spark.range(4 * times).select(F.col("id").alias("doc_id"), F.element_at(
        texts, (F.col("id") % 4 + 1).cast("int")).alias("text"))
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"),
                         F.lit(0).alias("toxic"))
    return docs, labels


def test_values_do_not_move_with_the_size(spark):
    small, large = (quality.judge(*repeated(spark, n)) for n in (5, 11_000))
    values = {k: r["value"] for k, r in results(small).items()}
    for row in large.groupBy((F.col("doc_id") % 4).alias("k")).agg(
            F.min("value").alias("low"), F.max("value").alias("high")).collect():
        assert row.low == pytest.approx(values[row.k], abs=1e-6)
        assert row.high == pytest.approx(values[row.k], abs=1e-6)


def test_every_trusted_row_counts(spark):
    """A word that only the last of 22,000 trusted documents says is in the target."""
    docs = spark.range(22_000).select(F.col("id").alias("doc_id"), F.lit("the rain").alias("text"))
    said = spark.createDataFrame([(i, f"word{i} word{i}") for i in range(22_000, 22_300)], docs.schema)
    docs = docs.unionByName(said)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert all(abs(r["value"]) < 1e-6 for r in results(quality.judge(docs, labels)).values())


@pytest.mark.parametrize("chunk, fan", [(1 << 20, 256), (1 << 17, 3), (1 << 16, 7)])
def test_values_are_of_exact_ngrams(spark, monkeypatch, chunk, fan):
    """Far more n-grams than a fixed number of buckets could tell apart, in one level and in several."""
    monkeypatch.setattr(quality, "CHUNK", chunk, raising=False)
    monkeypatch.setattr(quality, "FAN", fan)
    r = random.Random(5)
    texts = [" ".join(f"w{r.randrange(200_000)}" if r.random() < 0.7 else r.choice("abcdef")
                      for _ in range(r.randint(0, 2_000))) for _ in range(300)]
    labels = spark.createDataFrame([(i, i % 3 % 2, 0) for i in range(300)], LABELS)
    grams = [Counter(w := t.split()) + Counter(zip(w, w[1:])) for t in texts]
    raw, target = sum(grams, Counter()), sum(grams[1::3], Counter())
    assert len(raw) > 200_000
    every, good = raw.total(), target.total()
    rows = results(quality.judge(documents(spark, *texts), labels))
    for i, counts in enumerate(grams):
        expected = sum(n * math.log((target[g] / good + quality.PRIOR) / (raw[g] / every + quality.PRIOR))
                       for g, n in counts.items()) / max(counts.total(), 1)
        assert rows[i]["value"] == pytest.approx(expected, abs=1e-6)


def test_blobs_grow_with_the_chunks(spark, monkeypatch):
    """Eight times the chunks send eight times the parts, not sixty-four times."""
    monkeypatch.setattr(quality, "FAN", 4)
    for chunks in (1, 3, 4, 5, 16, 17, 64, 1000, 10**7):
        fan, levels = quality._levels(chunks)
        assert fan <= 4 and fan ** levels >= chunks and (fan - 1) ** levels < chunks
    docs, labels = repeated(spark, 500)
    sent = []

    def keep(df, label, f=quality.keep):
        kept = f(df, label)
        if label == "ngram-parts":
            sent.append(kept.count())
        return kept

    monkeypatch.setattr(quality, "keep", keep)
    answers = {}
    for chunks in (8, 64):
        sent.clear()
        answers[chunks] = quality._counts(quality._dealt(docs, labels, chunks), chunks, 40).count() + sum(sent)
    assert answers[64] <= 8 * 2 * answers[8]


def test_a_hot_id_is_dealt_to_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", 2000)
    texts = [f"the men went home before dark on day {k} of the long rain" for k in range(300)]
    rows = [(5 if k < 150 else None if k < 200 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(5, 1, 0), (210, 1, 0), (211, 1, 1)], LABELS)
    dealt = quality._dealt(docs, labels, 8)
    assert dealt.where(F.array_contains("ids", 5) & F.col("packed").isNotNull()).select("chunk").distinct().count() > 4
    grams = [Counter(w := t.split()) + Counter(zip(w, w[1:])) for t in texts]
    raw, target = sum(grams, Counter()), sum([g for (i, _), g in zip(rows, grams) if i in (5, 210)], Counter())
    values = sorted(sum(n * math.log((target[g] / target.total() + quality.PRIOR) / (raw[g] / raw.total() + quality.PRIOR))
                        for g, n in counts.items()) / counts.total() for counts in grams)
    found = sorted(r.value for r in quality.judge(docs, labels).collect())
    assert found == pytest.approx(values, abs=1e-6)
