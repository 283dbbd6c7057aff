"""Secrets in large texts, and all added spans against a plain version."""

import base64
import random
import re
import time
from collections import Counter
from math import inf, log2

import pytest
from odd import documents, results
from pyspark.sql import functions as F
from test_texts import brute_secrets

from cartwheel.llm import arrays, secrets

RULES = secrets.Entropy()


def most(text, window=20):
    return max(-sum(n / window * log2(n / window) for n in Counter(text[k:k + window]).values())
               for k in range(len(text) - window + 1))


def brute_spans(text):
    """Base spans and every candidate without overlap that reaches its class's bits."""
    base = brute_secrets(text)
    taken = [tuple(map(int, b.split(":")[1:])) for b in base]
    found = []
    pattern = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"
    for m in re.finditer(pattern, text):
        start, end, value = m.start(), m.end(), m.group()
        if any(a < end and start < b for a, b in taken) or any(re.search(p, value) for p in RULES.allowed):
            continue
        needed = next(bits for p, bits in RULES.bits if re.search(p, value))
        if needed < inf and most(value) >= needed:
            found.append(f"entropy:{start}:{end}")
    order = ["assign", "access", "hex", "entropy"]
    return sorted(base + found, key=lambda s: (int(s.split(":")[1]), order.index(s.split(":")[0])))


def random_text(r):
    parts = []
    for _ in range(r.randint(0, 14)):
        kind = r.randrange(7)
        size = r.randint(10, 45)
        alphabet = [secrets.ALPHABET, "0123456789abcdef", "abcdefghij0123", "ABCDEF0123456789", "ab1", "0123456789"][kind % 6]
        value = "".join(r.choices(alphabet, k=size))
        parts.append(r.choice(["", "password=", "token: '", "AKIA", "example_", "x "]) + value)
    return r.choice([" ", "\n", "é ", "\U0001F600"]).join(parts)


def test_all_spans_equal_a_plain_version(spark):
    r = random.Random(4)
    texts = [random_text(r) for _ in range(300)] + [" ".join(random_text(r) for _ in range(40)) for _ in range(3)]
    rows = results(secrets.find_secrets(documents(spark, *texts)))
    expected = [",".join(brute_spans(t)) for t in texts]
    assert [rows[i]["spans"] for i in range(len(texts))] == expected
    assert sum("entropy" in e for e in expected) > 50
    clean = results(secrets.redact(documents(spark, *texts)))
    for i, text in enumerate(texts):
        out, at = "", 0
        for start, end in (map(int, s.split(":")[1:]) for s in expected[i].split(",") if s):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        assert clean[i]["text"] == out + text[at:]


@pytest.mark.parametrize("text, n_assign, n_added", [
    (base64.b64encode(random.Random(1).randbytes(750_000)).decode(), 0, 1),
    (" ".join(f"password=abcdefghijkl{k}" for k in range(100_000)), 100_000, 0),
    (" ".join(f"token={k}abcdefghijklm kJ8vQ2xLm9ZrT4wYb7NcD1sF{k}" for k in range(30_000)), 30_000, 30_000),
    ("a@a " * 250_000, 0, 0), ("token=" * 170_000, 1, 0), ("1" * 1_000_000, 0, 0), ("token" + " " * 1_000_000, 0, 0),
], ids=["base64", "assigns", "both", "addresses", "keywords", "digits", "spaces"])
def test_large_texts_take_seconds(spark, text, n_assign, n_added):
    start = time.monotonic()
    row = secrets.find_secrets(documents(spark, text)).first()
    clean = secrets.redact(documents(spark, text)).first().text
    assert time.monotonic() - start < 120
    assert (row.n_assign, row.spans.count("entropy")) == (n_assign, n_added)
    assert clean.count("[SECRET]") == n_assign + n_added + row.n_hex


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 16_384, 20_000])
def test_running_sums_and_maxima(spark, n):
    r = random.Random(n)
    values = [r.randint(0, 99) for _ in range(n)]
    row = spark.createDataFrame([(values,)], "v array<int>").select(
        arrays.running_sum(F.col("v")).alias("s"), arrays.running_max(F.col("v")).alias("m")).first()
    total, top, sums, tops = 0, -1, [], []
    for v in values:
        total, top = total + v, max(top, v)
        sums.append(total)
        tops.append(top)
    assert (row.s, row.m) == (sums, tops)


def test_parts_of_a_text(spark):
    text = "é\U0001F600ab\n" * 3000
    spans = [(0, 0), (0, 1), (4095, 4097), (0, len(text)), (4096, 8192), (14_999, 15_000), (100, 9000)]
    frame = spark.createDataFrame([(text, a, b) for a, b in spans], "text string, a int, b int")
    got = frame.select(arrays.between(arrays.pieces(F.col("text")), F.col("a"), F.col("b")).alias("x")).collect()
    assert [g.x for g in got] == [text[a:b] for a, b in spans]
