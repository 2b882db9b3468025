"""Views of the sample star schema as restaurant data.

Users of ``events`` act as restaurants, described by ``customer`` and
``nation``; one event type stands for the health department, every other one is a
review on some site.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SITE_EVENTS = {"google_reviews": "view", "yelp_reviews": "click", "purchase_reviews": "purchase"}
OTHER_SITE = "other_reviews"
SITES = (*SITE_EVENTS, OTHER_SITE)
HEALTH_EVENT = "signup"
MASKED = "masked"


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def restaurants(spark: SparkSession, folder: str) -> DataFrame:
    """Name, county and cuisine per restaurant."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("restaurant_id"),
        F.col("c_name").alias("restaurant_name"),
        F.col("n_name").alias("county"),
        F.col("c_mktsegment").alias("cuisine"),
    )


def _stars(column: str):
    return (F.floor(column).cast("bigint") % 5 + 1).cast("int")


def all_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews of all sites without restaurant attributes, in one scan.

    ``posted_hour`` splits them into uploads.
    """
    site = F.lit(OTHER_SITE)
    for name, event in SITE_EVENTS.items():
        site = F.when(F.col("event_type") == event, name).otherwise(site)
    return (
        table(spark, folder, "events")
        .where(~F.col("event_type").eqNullSafe(HEALTH_EVENT))
        .select(
            F.col("event_id").cast("string").alias("review_id"),
            F.col("user_id").cast("string").alias("restaurant_id"),
            _stars("value").alias("rating"),
            F.lit(MASKED).alias("reviewer_name"),
            F.col("props").alias("comments"),
            F.lit("add").alias("operation"),
            F.col("ts").cast("date").alias("review_date"),
            F.coalesce(F.hour("ts"), F.lit(0)).alias("posted_hour"),
            site.alias("site"),
        )
    )


def reviews(spark: SparkSession, folder: str, site: str | None = None) -> DataFrame:
    """Reviews of one site, or of all sites together, without the site column."""
    rows = all_reviews(spark, folder)
    return (rows if site is None else rows.where(F.col("site") == site)).drop("site")


def health(spark: SparkSession, folder: str) -> DataFrame:
    """Inspections without restaurant attributes; a day may have several."""
    return (
        table(spark, folder, "events")
        .where(F.col("event_type") == HEALTH_EVENT)
        .select(
            F.col("user_id").cast("string").alias("restaurant_id"),
            F.col("ts").cast("date").alias("grade_date"),
            _stars("value").alias("health_grade"),
            F.coalesce(F.hour("ts"), F.lit(0)).alias("posted_hour"),
        )
    )


def named(df: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    return df.join(restaurants(spark, folder), "restaurant_id", "left")


def raw_reviews(spark: SparkSession, folder: str, site: str | None = None) -> DataFrame:
    """Reviews as they come in a file, with ``posted_hour`` as an extra column."""
    return named(reviews(spark, folder, site), spark, folder).select(
        "review_id",
        F.date_format("review_date", "yyyyMMdd").alias("review_date"),
        "restaurant_id",
        "restaurant_name",
        "county",
        F.col("rating").cast("string").alias("rating"),
        "reviewer_name",
        "comments",
        "operation",
        "posted_hour",
    )


def raw_health(spark: SparkSession, folder: str) -> DataFrame:
    """Inspections as they come in a file, with ``posted_hour`` as an extra column."""
    return named(health(spark, folder), spark, folder).select(
        F.date_format("grade_date", "yyyyMMdd").alias("grade_date"),
        "restaurant_id",
        "restaurant_name",
        "cuisine",
        "county",
        F.col("health_grade").cast("string").alias("health_grade"),
        "posted_hour",
    )


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """``lineitem`` as a longer review series: suppliers rated on their shipping days."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("restaurant_id"),
        F.col("l_shipdate").cast("date").alias("review_date"),
        _stars("l_quantity").alias("rating"),
    )
