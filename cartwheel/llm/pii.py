"""Personal data by anchor expansion.

One pass of an Aho-Corasick automaton finds anchors: at-signs, plus signs, digits, scheme
separators and the words that announce an identifier. At an anchor a small parser expands
to the boundaries of the item and validates it; text without anchors is never parsed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from cartwheel.llm.batches import as_texts, bound_batches

# The base kinds in the order that breaks ties, then the added ones.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("account", "login_url")
KINDS = BASE_KINDS + ADDED_KINDS

CUES = ("iban", "account", "acct", "passport", "ssn", "tax id", "konto", "cuenta", "compte")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[ -]?[0-9])*")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ACCOUNT = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?|#))?[ ]?[:=]?[ ]?([A-Z]{0,2}[0-9][A-Z0-9]*(?:[ -][A-Z0-9]{2,})*)")
_LOGIN = re.compile(r"[^\s/@:]+(?::[^\s/@]*)?@[A-Za-z0-9.-]+(?::[0-9]+)?")

SCHEMA = ("doc_id {id}, n_email long, n_ip long, n_card long, n_phone long, "
          "base_sha256 string, spans string")


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    found.add_word("://", "scheme")
    for cue in CUES:
        for written in (cue, cue.upper(), cue.capitalize()):
            found.add_word(written, "cue")
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def valid_iban(value: str) -> bool:
    turned = value[4:] + value[:4]
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    """The identifier after a cue: an IBAN that checks out, or one with six digits or more."""
    if at < len(text) and text[at].isalpha() or not (m := _ACCOUNT.match(text, at)):
        return None
    value = re.sub("[ -]", "", m.group(1))
    if re.match("[A-Z]{2}[0-9]{2}", value):
        good = valid_iban(value)
    else:
        good = 6 <= sum(c.isdigit() for c in value) <= 20
    return m.span(1) if good else None


def private_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index in KINDS, end) of all spans in order; offsets in code points."""
    found = []
    mail_end = dotted_end = grouped_end = account_end = 0
    for last, anchor in automaton().iter(text):
        if anchor == "digit":
            if last >= dotted_end:
                chain = _DOTTED.match(text, last)
                dotted_end = chain.end()
                parts = chain.group().split(".")
                start = last
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i:i + 4]
                    end = start + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                        found.append((start, 1, end))
                    start = end + 1
            if last >= grouped_end:
                chain = _GROUPED.match(text, last)
                grouped_end = chain.end()
                if grouped_end - last >= 14:
                    digits = chain.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        found.append((last, 2, grouped_end))
        elif anchor == "at":
            start = last
            while start > mail_end and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _DOMAIN.match(text, last + 1)):
                mail_end = m.end()
                found.append((start, 0, mail_end))
        elif anchor == "plus":
            if m := _DIALLED.match(text, last):
                if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    found.append((last, 3, m.end()))
        elif anchor == "scheme":
            start = last - 2
            while start > 0 and last - start < 20 and text[start - 1] in _SCHEME:
                start -= 1
            if start < last - 2 and (m := _LOGIN.match(text, last + 1)):
                found.append((start, 5, m.end()))
        elif last >= account_end and (span := _account(text, last + 1)):
            account_end = span[1]
            found.append((span[0], 4, span[1]))
    return sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for start, k, end in spans)


def find_private(docs: DataFrame) -> DataFrame:
    """Personal data in every whole text of ``docs`` (doc_id, text).

    Gives a row per input row: doc_id, the counts of the base kinds, base_sha256 (of the base
    spans) and spans (all, as kind:start:end by start, then kind; code points, end
    exclusive). A NULL or empty text has no spans; repeated rows stay; an empty table gives
    an empty one; other columns are not read.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [private_spans(t) for t in as_texts(batch.column(1))]
            base = [[s for s in row if s[1] < len(BASE_KINDS)] for row in spans]
            counts = [pa.array([sum(s[1] == k for s in row) for row in base], pa.int64())
                      for k in range(len(BASE_KINDS))]
            digests = [hashlib.sha256(listed(row).encode()).hexdigest() for row in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(digests, pa.string()),
                 pa.array([listed(row) for row in spans], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return bound_batches(docs.select("doc_id", "text")).mapInArrow(scan, SCHEMA.format(id=kind))
