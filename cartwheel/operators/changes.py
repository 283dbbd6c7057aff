"""Which rows a load changed, and which months of the sales fact that touches.

Two states of a table are compared key by key, in one grouping of both: each task adds up a digest
per key, with a minus sign for the state before, so a key of any number of rows is one row before the
shuffle, and a key changed if its digests or its number of rows do not cancel out. Changed keys are carried through the tables to orders, and from
the orders' dates, before and after, to months.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import month_start
from cartwheel.session import keep

# Fixed value: the stamp of a load, which says nothing about the row.
STAMP = "_loaded_at"

Staged = Mapping[str, DataFrame]


def _digests(rows: DataFrame, key: str, sign: int) -> DataFrame:
    """A row's key, ``sign``, and its digest of 128 bits in four numbers, with that sign."""
    # A hash passes over NULLs, so each column says itself whether it is one.
    values = [x for c in sorted(rows.columns) if c != STAMP for x in (F.col(c), F.col(c).isNull())]
    halves = rows.select(F.col(key), F.xxhash64(*values).alias("one"), F.xxhash64(F.lit(1), *values).alias("two"))
    # Numbers of 32 bits: their sums are exact without decimals.
    return halves.select(key, F.lit(sign).alias("n"), *(
        (F.lit(sign) * part).alias(f"{c}_{name}") for c in ("one", "two")
        for name, part in (("high", F.shiftright(c, 32)), ("low", F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))))))


def changed_keys(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` whose rows differ between two states of a table, in any column but the stamp.

    Order does not count, repeated rows do; a NULL key is a key. Columns that only one state
    has are not compared.
    """
    both = [c for c in before.columns if c in after.columns]
    rows = _digests(before.select(*both), key, -1).unionByName(_digests(after.select(*both), key, 1))
    sums = [c for c in rows.columns if c != key]
    moved = rows.groupBy(key).agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    return moved.where(" OR ".join(f"_{c} <> 0" for c in sums)).select(key)


def _with(rows_before: DataFrame, rows_after: DataFrame, keys: DataFrame, key: str, wanted: str) -> DataFrame:
    """The ``wanted`` values of rows that have one of the keys, in either state."""
    rows = rows_before.select(key, wanted).unionByName(rows_after.select(key, wanted))
    return rows.join(keys, key, "left_semi").select(wanted)


def changed_orders(before: Staged, after: Staged) -> DataFrame:
    """The ids of orders that the sales fact shows differently, once each.

    Takes the staged tables ``orders``, ``customers``, ``payments``, ``items``, ``products``,
    ``categories`` and ``reviews`` in two states. A table that is the same object in both is not
    read; tables of one row per order and tables that orders look up are treated alike.
    """
    def changed(name: str, key: str) -> DataFrame | None:
        return None if before[name] is after[name] else changed_keys(before[name], after[name], key)

    found = [changed(name, "order_id") for name in ("orders", "payments", "items", "reviews")]
    if (people := changed("customers", "customer_id")) is not None:
        found.append(_with(before["orders"], after["orders"], people, "customer_id", "order_id"))
    goods = [changed("products", "product_id")]
    if (names := changed("categories", "category_name_pt")) is not None:
        goods.append(_with(before["products"], after["products"], names, "category_name_pt", "product_id"))
    for keys in (g for g in goods if g is not None):
        found.append(_with(before["items"], after["items"], keys, "product_id", "order_id"))
    found = [f for f in found if f is not None]
    if not found:
        return after["orders"].select("order_id").limit(0)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.where("order_id IS NOT NULL").distinct()


def touched_months(changed: DataFrame, before: DataFrame, after: DataFrame) -> list[date]:
    """First days of the months that changed orders were bought in, before or after the change.

    A number of months: at most one row per month reaches the driver.
    """
    dates = before.select("order_id", "purchased_at").unionByName(after.select("order_id", "purchased_at"))
    months = dates.join(changed, "order_id", "left_semi").select(
        month_start(F.to_date("purchased_at")).alias("month")).where("month IS NOT NULL").distinct()
    return sorted(r["month"] for r in months.collect())


def months_to_refresh(before: Staged, after: Staged) -> list[date]:
    """The months of the sales fact that differ between two states of the staged tables."""
    changed = keep(changed_orders(before, after), "changed-orders")
    return touched_months(changed, before["orders"], after["orders"])
