"""Category taxonomy: load, enrich, coverage and gap reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.schemas import RAW_SCHEMAS

# Catalyst broadcasts a join side on its own when its estimated size is under
# spark.sql.autoBroadcastJoinThreshold (and AQE re-checks with runtime sizes);
# beyond it the join falls back to a shuffle join. No hint is forced here, so a
# user taxonomy that grows large stays safe.


def clean_taxonomy(raw: DataFrame) -> DataFrame:
    """Trim the three columns and keep one row per source category.

    Duplicated source categories keep a deterministic winner (greatest
    normalized_category, then family), so enrichment never multiplies rows.
    """
    trimmed = raw.select(*(F.trim(F.col(c)).alias(c) for c in ("source_category", "normalized_category", "category_family")))
    w = Window.partitionBy("source_category").orderBy(
        F.col("normalized_category").desc_nulls_last(), F.col("category_family").desc_nulls_last()
    )
    return trimmed.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Read a taxonomy CSV (header source_category, normalized_category, category_family)."""
    raw = (
        spark.read.schema(RAW_SCHEMAS["taxonomy"]).option("header", True)
        .option("quote", '"').option("escape", '"').csv(path)
    )
    return clean_taxonomy(raw)


def taxonomy_from_rows(spark: SparkSession, rows) -> DataFrame:
    raw = spark.createDataFrame(list(rows), RAW_SCHEMAS["taxonomy"])
    return clean_taxonomy(raw)


def enrich_taxonomy(df: DataFrame, taxonomy: DataFrame, category_col: str) -> DataFrame:
    """Left join on the trimmed category: adds normalized_category and category_family."""
    tax = taxonomy.select(
        F.col("source_category").alias("_src"), "normalized_category", "category_family"
    )
    joined = df.join(tax, F.trim(F.col(category_col)) == F.col("_src"), "left")
    return joined.drop("_src")


def category_frequency(products: DataFrame, category_col: str = "product_category_name") -> DataFrame:
    """Rows per category (NULL category is its own row), most frequent first."""
    return (
        products.groupBy(F.col(category_col).alias("category"))
        .agg(F.count(F.lit(1)).alias("products"))
        .orderBy(F.col("products").desc(), F.col("category").asc_nulls_first())
    )


def taxonomy_gaps(products: DataFrame, taxonomy_raw: DataFrame, category_col: str = "product_category_name") -> DataFrame:
    """Set comparison of categories in the data vs in the taxonomy.

    One full outer join of the two distinct sets; each value is flagged
    ``missing_in_taxonomy`` (in data only) or ``extra_in_taxonomy`` (taxonomy
    only). Duplicated source categories of the taxonomy are listed as
    ``duplicate_in_taxonomy`` with their multiplicity.
    """
    data = products.select(F.trim(F.col(category_col)).alias("category")).where(F.col("category").isNotNull()).distinct()
    tax_counts = (
        taxonomy_raw.select(F.trim("source_category").alias("category"))
        .where(F.col("category").isNotNull())
        .groupBy("category").agg(F.count(F.lit(1)).alias("taxonomy_rows"))
    )
    both = data.withColumn("_in_data", F.lit(True)).join(tax_counts, "category", "full_outer")
    status = (
        F.when(F.col("taxonomy_rows").isNull(), F.lit("missing_in_taxonomy"))
        .when(F.col("_in_data").isNull(), F.lit("extra_in_taxonomy"))
    )
    gaps = both.select("category", status.alias("status"), F.lit(None).cast("long").alias("taxonomy_rows")).where(
        F.col("status").isNotNull()
    )
    dups = tax_counts.where(F.col("taxonomy_rows") > 1).select(
        "category", F.lit("duplicate_in_taxonomy").alias("status"), "taxonomy_rows"
    )
    return gaps.unionByName(dups)


def taxonomy_coverage(products: DataFrame, category_col: str = "product_category_name") -> DataFrame:
    """One row: products with a category, how many are mapped, coverage %."""
    has_cat = F.col(category_col).isNotNull()
    mapped = has_cat & F.col("normalized_category").isNotNull() & F.col("category_family").isNotNull()
    return products.agg(
        F.count_if(has_cat).alias("categorised_products"),
        F.count_if(mapped).alias("mapped_products"),
        F.count_if(F.col(category_col).isNull()).alias("null_category_products"),
    )
