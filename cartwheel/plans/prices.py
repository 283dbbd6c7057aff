"""Price history of products, and the views of it that the price pages show."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import ratio, rounded, shorten, version_label

# Rows of the rankings, versions a product needs, widths of names.
GALLERY_ROWS = 30
TOP_ROWS = 10
MIN_VERSIONS = 2
GALLERY_NAME_WIDTH = 50
DROP_NAME_WIDTH = 70


def mart_price_history(history: DataFrame, as_of: date) -> DataFrame:
    """One row per product and version, with the change against the version before.

    The first version, and one whose predecessor had no price, is a first record.
    A price that becomes NULL, or a change of status or category only, is unchanged.
    """
    by_start = Window.partitionBy("product_id").orderBy("dbt_valid_from")
    price, previous = F.col("price_ars"), F.col("prev_price_ars")
    base = F.coalesce(previous, price)
    start, end = F.to_date("dbt_valid_from"), F.to_date("dbt_valid_to")
    versions = history.select(
        "product_id", "category_id", "category_name", "product_name", "status", "price_ars",
        "currency",
        start.alias("valid_from"),
        end.alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"),
        F.datediff(F.coalesce(end, F.lit(as_of)), start).alias("price_duration_days"),
        F.row_number().over(by_start).alias("price_version"),
        F.lag("price_ars").over(by_start).alias("prev_price_ars"),
    )
    return versions.select(
        "*",
        rounded(price - base, 2).alias("price_delta_ars"),
        rounded(ratio((price - base) * 100, base), 2).alias("price_change_pct"),
        F.when(previous.isNull(), "first_record")
         .when(price > previous, "increase")
         .when(price < previous, "decrease")
         .otherwise("unchanged").alias("price_change_direction"),
    )


def price_listing(prices: DataFrame) -> DataFrame:
    return prices.select(
        "product_name", "category_name", "price_ars", "prev_price_ars", "price_delta_ars",
        "price_change_pct", "price_change_direction", "valid_from", "valid_to", "is_current",
        "price_version",
    ).orderBy("product_name", "valid_from")


def _growth(name: str) -> Column:
    """Highest over lowest price in percent; NULL where the lowest is zero."""
    low, high = F.min("price_ars"), F.max("price_ars")
    return rounded(ratio((high - low) * 100, low), 1).alias(name)


def price_ranking(prices: DataFrame) -> DataFrame:
    """Growth by product name and category, for those with more than one version."""
    return (
        prices.groupBy("product_name", "category_name")
        .agg(F.count(F.lit(1)).alias("price_versions"),
             F.min("price_ars").alias("start_price"),
             F.max("price_ars").alias("peak_price"),
             _growth("total_growth_pct"))
        .where(F.col("price_versions") >= MIN_VERSIONS)
        .orderBy(F.col("total_growth_pct").desc_nulls_last(), "product_name", "category_name")
    )


def top_growth(ranking: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return ranking.orderBy(F.col("total_growth_pct").desc_nulls_last(),
                           "product_name", "category_name").limit(n)


def price_kpis(prices: DataFrame, ranking: DataFrame) -> DataFrame:
    """One row: products tracked, changes seen, highest growth (0 when none).

    Products without a name count together as one.
    """
    name = F.col("product_name")
    counts = prices.agg(
        (F.count_distinct(name) + F.coalesce(F.max(name.isNull().cast("int")), F.lit(0)))
        .alias("products_tracked"),
        F.count_if(F.col("price_version") > 1).alias("price_changes"),
    )
    best = ranking.agg(F.coalesce(F.max("total_growth_pct"), F.lit(0.0)).alias("max_growth_pct"))
    return counts.unionByName(best, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("products_tracked", "price_changes", "max_growth_pct")])


def product_names(prices: DataFrame, ranking: DataFrame, show_all: bool) -> DataFrame:
    """Names to choose from: all, or only products with changes."""
    return (prices if show_all else ranking).select("product_name").distinct()


def product_detail(prices: DataFrame, product_name: str | Column) -> DataFrame:
    """The versions of one product name with chart labels."""
    wanted = F.lit(product_name) if isinstance(product_name, str) else product_name
    return (
        prices.where(F.col("product_name") == wanted)
        .select("price_version", "valid_from", "price_ars", "price_delta_ars",
                "price_change_pct", "price_change_direction", "is_current",
                version_label(F.col("valid_from"), F.col("price_version")).alias("label"))
        .orderBy("valid_from")
    )


def category_volatility(ranking: DataFrame) -> DataFrame:
    """Products and growth by category; growth has one decimal and is summed exactly."""
    growth = F.col("total_growth_pct")
    total = F.sum(growth.cast("decimal(18,1)")).cast("double")
    return (
        ranking.where(F.col("category_name").isNotNull())
        .groupBy("category_name")
        .agg(F.count("product_name").alias("products"),
             F.try_divide(total, F.count(growth).cast("double")).alias("avg_growth"),
             F.max(growth).alias("max_growth"))
        .orderBy(F.col("avg_growth").desc_nulls_last(), "category_name")
    )


def price_gallery(prices: DataFrame, n: int = GALLERY_ROWS) -> DataFrame:
    """The ``n`` products that grew most.

    ``peak_price`` is the highest price; ``current_price`` is the one of the open
    version, NULL for a product that is gone.
    """
    return (
        prices.groupBy("product_id", "product_name", "category_name")
        .agg(F.count(F.lit(1)).alias("price_versions"),
             F.min("price_ars").alias("start_price"),
             F.max("price_ars").alias("peak_price"),
             F.max(F.when(F.col("is_current"), F.col("price_ars"))).alias("current_price"),
             _growth("growth_pct"))
        .where(F.col("price_versions") >= MIN_VERSIONS)
        .withColumn("short_name", shorten(F.col("product_name"), GALLERY_NAME_WIDTH))
        .withColumn("price_rise", F.col("peak_price") - F.col("start_price"))
        .orderBy(F.col("growth_pct").desc_nulls_last(), "product_id")
        .limit(n)
    )


def product_history(prices: DataFrame, product_id: str | Column) -> DataFrame:
    wanted = F.lit(product_id) if isinstance(product_id, str) else product_id
    return (
        prices.where(F.col("product_id") == wanted)
        .select("price_version", "valid_from", "price_ars", "price_delta_ars",
                "price_change_pct", "price_change_direction")
        .orderBy("valid_from")
    )


def price_drops(prices: DataFrame, directional: bool = False) -> DataFrame:
    """Products whose prices differ, by the gap from highest to lowest.

    That includes products that only rose. With ``directional`` a product is kept
    only if its latest price is below its highest, and the gap is measured to it.
    """
    low, high = F.min("price_ars"), F.max("price_ars")
    latest = F.max_by("price_ars", "price_version")
    now = latest if directional else low
    return (
        prices.groupBy("product_id", "product_name", "category_name")
        .agg(F.count(F.lit(1)).alias("price_versions"),
             high.alias("peak_price"),
             now.alias("current_price"),
             rounded(ratio((now - high) * 100, high), 1).alias("drop_pct"))
        .where((F.col("price_versions") >= MIN_VERSIONS)
               & (F.col("current_price") < F.col("peak_price")))
        .withColumn("short_name", F.substring("product_name", 1, DROP_NAME_WIDTH))
        .orderBy("drop_pct", "product_id")
    )


def price_waterfall(prices: DataFrame) -> DataFrame:
    """Steps of the price of every product: the start, then the change of each version."""
    first = F.col("price_version") == 1
    return prices.select(
        "product_id",
        "price_version",
        F.when(first, "Start").otherwise(
            F.concat(F.lit("v"), F.col("price_version").cast("string"))).alias("label"),
        F.when(first, "absolute").otherwise("relative").alias("measure"),
        F.when(first, F.col("price_ars")).otherwise(F.col("price_delta_ars")).alias("value"),
    ).orderBy("product_id", "price_version")


def product_waterfall(prices: DataFrame, product_id: str) -> DataFrame:
    return price_waterfall(prices.where(F.col("product_id") == product_id))


def cap_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """At most ``n`` rows of an answer, in a stated order."""
    return df.orderBy(*order).limit(n)
