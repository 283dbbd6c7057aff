"""The append-only log of questions and the SQL generated for them."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.schemas import QUERY_AUDIT

log = logging.getLogger(__name__)


def audit_records(df: DataFrame) -> DataFrame:
    """Bring a batch to the log's schema; a missing user or token count gets its default."""
    defaults = {"user_id": F.lit("anonymous"), "tokens_used": F.lit(0)}
    columns = []
    for f in QUERY_AUDIT:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        value = value.cast(f.dataType)
        if f.name in defaults:
            value = F.coalesce(value, defaults[f.name].cast(f.dataType))
        columns.append(value.alias(f.name))
    return df.select(*columns)


def append_audit(df: DataFrame, path: str) -> bool:
    """Append the batch. A failure is logged and reported, never raised."""
    try:
        audit_records(df).write.mode("append").parquet(path)
        return True
    except Exception as error:
        log.warning("audit records not written: %s", error)
        return False


def queries_by_table(audit: DataFrame) -> DataFrame:
    """How often each table was asked for."""
    return (audit.select(F.explode("tables_referenced").alias("table_name"))
                 .groupBy("table_name").agg(F.count(F.lit(1)).alias("query_count")))


def tokens_by_user(audit: DataFrame) -> DataFrame:
    return audit.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("query_count"),
        F.sum("tokens_used").alias("tokens_used"),
    )
