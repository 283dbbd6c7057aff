"""Periodic runs against a search of every lag, and the loops that the query plants."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import EXPECTED_COUNTS, WORD, count_by, documents, no_documents, odd_documents, results

from cartwheel.llm import runs


def brute_runs(words, least=12):
    """Every lag by itself; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            end = i
            while end < len(words) and words[end] == words[end - q]:
                end += 1
            if end - i + q >= max(least, 2 * q):
                found.setdefault((i - q, end - i + q), q)
            i = end + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def listed(found):
    return [tuple(run) for run in found.tolist()]


blocks = st.lists(st.tuples(st.lists(st.sampled_from("aabbcdef"), min_size=1, max_size=9), st.integers(1, 7)), max_size=7)


@settings(max_examples=300, deadline=None)
@given(st.lists(blocks, min_size=1, max_size=3), st.sampled_from([2, 5, 12]))
def test_runs_of_any_words(texts, least):
    texts = [[w.encode() for block, times in text for w in block * times] for text in texts]
    assert [listed(r) for r in runs.runs_of(texts, least)] == [brute_runs(t, least) for t in texts]


def test_clashing_hashes_are_noticed(monkeypatch):
    texts = [[b"a", b"b", b"c"] * 6, [b"x", b"b", b"y"] * 5 + [b"z"]]
    asked = []

    def weak(values, mix=runs.mix):
        asked.append(1)
        return values % 7 if len(asked) < 6 else mix(values)

    monkeypatch.setattr(runs, "mix", weak)
    assert [listed(r) for r in runs.runs_of(texts)] == [brute_runs(t) for t in texts]


def fibonacci(n):
    a, b = b"a", b"ab"
    while len(b) < n:
        a, b = b, b + a
    return [bytes([c]) for c in b[:n]]


@pytest.mark.parametrize("words, n_runs", [
    ([b"a"] * 200_000, 1), (([b"a"] * 500 + [b"b"]) * 300, 301),
    ([b"w%d" % (i % 6667) for i in range(200_000)], 1), (fibonacci(100_000), None)])
def test_long_periodic_texts_take_seconds(words, n_runs):
    found = runs.runs_of([words])[0]
    assert n_runs is None and len(found) or len(found) == n_runs


def test_runs_of_odd_rows(spark):
    found = runs.find_runs(odd_documents(spark))
    assert count_by(found) == EXPECTED_COUNTS
    rows = results(found)
    assert (rows[2]["n_words"], rows[2]["runs"], rows[2]["collapsed"]) == (0, [], "")
    assert rows[4]["n_words"] == 0 and rows[4]["collapsed"] == ""
    assert rows[5]["runs"] == [{"start": 0, "length": 40000, "period": 5}]
    assert rows[5]["collapsed"] == "Thon wherea and the onnd."
    assert rows[7]["collapsed"] == "\x00\x01 $1 \\ </s>[INST] 日本語 \x1f\x85"
    assert runs.find_runs(no_documents(spark)).count() == 0
    digests = results(runs.digests(found))
    assert digests[2]["start"] is None and digests[2]["exponent_milli"] is None
    assert digests[5]["exponent_milli"] == 8_000_000


def test_query_against_every_lag(spark):
    words = [f"{c}{d}" for c in "bcdfg" for d in "aeiou"]
    texts = [" ".join((words[k % 7:] + words[:k % 25] * (k % 4)) * (1 + k % 3)) for k in range(250)] + [None, "", "  x\n"]
    found = results(runs.digests(runs.find_runs(runs.with_loops(documents(spark, *texts)))))
    n_looped = 0
    for doc_id, text in enumerate(texts):
        own = WORD.findall(text or "")
        crc, n = zlib.crc32(str(doc_id).encode()), len(own)
        if crc % 10 == 0 and n:
            g = crc // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            own = own[:a] + [own[a + (i - a) % p] for i in range(a, n)]
            n_looped += 1
        expected = brute_runs(own)
        row = found[doc_id]
        assert row["n_runs"] == len(expected)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in expected)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(brute_collapse(own, expected).encode()).hexdigest()
        best = min(expected, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (best[1] and 1000 * best[1] // best[2])
    assert n_looped > 10
