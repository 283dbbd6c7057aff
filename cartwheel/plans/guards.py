"""Checks on questions, generated SQL and raw replies, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import text as X

# How much of an unreadable reply an error quotes, and the refusal texts.
ERROR_WIDTH = 300
PII_REFUSAL = "Question contains personal data. Please rephrase."
SQL_REFUSAL = "SQL validation failed: "
NO_STATEMENT = "No statement"
KEYWORD_REFUSAL = "Forbidden keyword: "
TABLE_REFUSAL = "Table not in allow-list: "
NO_JSON = "No JSON in response: "
UNREADABLE = "Failed to parse response: "


def pii_screen(df: DataFrame, text_col: str) -> DataFrame:
    """Flags for e-mail addresses and phone numbers in a text column."""
    value = F.col(text_col)
    return (
        df.withColumn("has_email", X.mentions_email(value))
        .withColumn("has_phone", X.mentions_phone(value))
        .withColumn("has_pii", F.col("has_email") | F.col("has_phone"))
    )


def sql_guard(df: DataFrame, sql_col: str, allowed: list[str] | None = None) -> DataFrame:
    """Whether a statement may run and why not: keywords first, then tables. NULL may not."""
    word = X.first_forbidden_keyword(F.col(sql_col))
    table = X.first_table_outside(X.mart_tables(F.col(sql_col)), allowed or X.ALLOWED_TABLES)
    return (
        df.withColumn("reason", F.when(F.col(sql_col).isNull(), NO_STATEMENT)
            .when(word.isNotNull(), F.concat(F.lit(KEYWORD_REFUSAL), word))
            .when(table.isNotNull(), F.concat(F.lit(TABLE_REFUSAL), table))
            .otherwise(""))
        .withColumn("is_valid", F.col("reason") == "")
    )


def parse_answer(df: DataFrame, raw_col: str) -> DataFrame:
    """SQL, explanation and tables of a raw reply, or an error that quotes it.

    The reply is read as one JSON object, with or without a code fence around it;
    failing that, whatever lies between its outermost braces is read.
    """
    body = X.strip_code_fence(F.col(raw_col))
    braces = X.outermost_braces(F.col("_body"))
    quoted = F.substring("_body", 1, ERROR_WIDTH)
    reply = F.coalesce(X.reply_object(F.col("_body")), X.reply_object(braces))
    return (
        df.withColumn("_body", body)
        .withColumn("_reply", reply)
        .withColumn("sql", F.when(F.col("_reply").isNotNull(),
                                  F.coalesce("_reply.sql", F.lit(""))))
        .withColumn("explanation", F.col("_reply.explanation"))
        .withColumn("tables_used", F.when(
            F.col("_reply").isNotNull(),
            F.coalesce("_reply.tables_used", F.array().cast("array<string>"))))
        .withColumn("error", F.when(F.col("_reply").isNull(), F.concat(
            F.when(braces.isNull(), NO_JSON).otherwise(UNREADABLE), quoted)))
        .drop("_body", "_reply")
    )


def answer_verdicts(df: DataFrame, question_col: str, raw_col: str) -> DataFrame:
    """The answer to every question, or the first reason to refuse it, as ``error``.

    A question with personal data is refused before its reply is read, a reply that
    cannot be read before its SQL is checked.
    """
    screened = pii_screen(df, question_col)
    checked = sql_guard(parse_answer(screened, raw_col), "sql")
    return checked.withColumn(
        "error",
        F.when(F.col("has_pii"), PII_REFUSAL)
        .when(F.col("error").isNotNull(), F.col("error"))
        .when(~F.col("is_valid"), F.concat(F.lit(SQL_REFUSAL), F.col("reason")))
    ).drop("has_email", "has_phone", "has_pii", "reason", "is_valid")
