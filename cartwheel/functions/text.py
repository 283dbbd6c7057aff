"""Text checks for questions, generated SQL and raw replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Personal-data patterns, tables open to questions, refused keywords.
PII_PATTERNS = [
    r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
]
ALLOWED_TABLES = ["mart_sales", "mart_cohorts", "mart_sellers", "mart_price_history", "dim_date"]
FORBIDDEN_KEYWORDS = [
    "DROP", "DELETE", "INSERT", "UPDATE", "TRUNCATE", "ALTER", "CREATE", "REPLACE",
]
MART_DATASET = "dataset_marts"

# Case folding, with letters and digits of every script counted as word characters.
_FOLD = "(?iU)"

REPLY_SCHEMA = "array<struct<sql string, explanation string, tables_used array<string>>>"


def mentions_email(text: Column) -> Column:
    """The plain search for the sign spares most texts the pattern."""
    return text.contains("@") & text.rlike(_FOLD + PII_PATTERNS[0])


def mentions_phone(text: Column) -> Column:
    return text.rlike(_FOLD + PII_PATTERNS[1])


def first_forbidden_keyword(sql: Column) -> Column:
    """The first keyword of the list that occurs as a whole word, or NULL."""
    upper = F.upper(sql)
    return F.coalesce(*[
        F.when(upper.rlike(rf"(?U)\b{word}\b"), F.lit(word)) for word in FORBIDDEN_KEYWORDS
    ])


def mart_tables(sql: Column) -> Column:
    """Every table named behind the mart dataset, in order, as spelt."""
    return F.regexp_extract_all(sql, F.lit(_FOLD + MART_DATASET + r"\.(\w+)"), F.lit(1))


def first_table_outside(tables: Column, allowed: list[str]) -> Column:
    known = [name.lower() for name in allowed]
    return F.get(F.filter(tables, lambda t: ~F.lower(t).isin(known)), F.lit(0))


def strip_code_fence(raw: Column) -> Column:
    trimmed = F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")
    opened = F.regexp_replace(trimmed, r"(?U)^```json\s*", "")
    return F.regexp_replace(opened, r"(?U)\s*```$", "")


def outermost_braces(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; NULL when there is none."""
    found = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    return F.nullif(found, F.lit(""))


def reply_object(text: Column) -> Column:
    """The text read as exactly one JSON object, else NULL.

    Reading it as the only element of a list also refuses text behind the object,
    which the reader of a bare object would skip.
    """
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), REPLY_SCHEMA,
                         {"allowSingleQuotes": "false", "allowNonNumericNumbers": "true"})
    return F.when(F.size(parsed) == 1, F.get(parsed, F.lit(0)))
