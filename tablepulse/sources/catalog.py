"""Stored tables as SQL tables.

Each stored table becomes an external table whose partitions are site, version and date.
Publishing again after a batch adds the partitions that the batch wrote, switches one
view to the new list of partitions, on which all other views rest, and takes the replaced
partitions out. So its work follows the batch, a query sees all tables of one release of
a site, and no table is missing in between.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StringType, StructType

from tablepulse import schemas
from tablepulse.layout import (
    FINAL_RATING,
    GRADE_RUNS,
    HEALTH_SITE,
    INPUT,
    RATING_SUM,
    RESTAURANTS,
    Site,
)
from tablepulse.sources.releases import (
    Release,
    current_release,
    list_file,
    load_release,
    release_numbers,
    released_sites,
)


class Fact(NamedTuple):
    """A stored table, and the schema and partition column by which it is published."""

    name: str
    table: str
    schema: StructType
    column: str


FACTS = (
    Fact("restaurants", RESTAURANTS, schemas.HEALTH_RESTAURANTS, "batch"),
    Fact("rating_sum", RATING_SUM, schemas.RATING_SUM, "review_date"),
    Fact("final_rating", FINAL_RATING, schemas.FINAL_RATING, "review_date"),
    Fact("grade_values", GRADE_RUNS, schemas.GRADE_RUNS, "valid_from"),
    Fact("reviews", INPUT, schemas.REVIEWS, "review_date"),
)
# Columns of each published view. Attributes come from the restaurants view.
COUNTS = (
    "coalesce(f.rating_sum, 0) AS rating_sum, coalesce(f.rating_count, 0) AS rating_count"
)
VIEW_COLUMNS = {
    "rating_sum": f"r.site, r.restaurant_id, r.restaurant_name, r.county, {COUNTS}, r.review_date",
    "final_rating": f"r.site, r.restaurant_name, r.county, {COUNTS}, r.review_date, "
    "f.final_rating, r.restaurant_id",
    "grade_values": "f.restaurant_id, explode(sequence(f.valid_from, "
    "coalesce(f.valid_to, f.valid_from))) AS grade_date, r.restaurant_name, r.cuisine, f.health_grade",
    "reviews": "f.site, f.review_id, f.restaurant_id, r.restaurant_name, r.county, f.rating, "
    "f.reviewer_name, f.comments, f.operation, f.review_date",
}
# Stored rows of the current partitions.
CURRENT_ROWS = """
    (SELECT f.* FROM `{facts}` f JOIN `{current}` c
     ON c.`table` = '{table}' AND c.site = f.site AND c.version = f.version
     AND c.value = CAST(f.{column} AS STRING))
"""
# Stored facts with the attributes beside them.
STORED_ROWS = """
    {rows} f LEFT JOIN `{restaurants}` r
    ON f.site = r.site AND f.restaurant_id = r.restaurant_id
"""
# Every day of a restaurant's span with the stored facts, for tables that leave days out.
EVERY_DAY = """
    (SELECT *, explode(sequence(first_date, last_date)) AS review_date
     FROM `{restaurants}` WHERE site <> '{health}') r LEFT JOIN {rows} f
    ON f.site = r.site AND f.restaurant_id = r.restaurant_id AND f.review_date = r.review_date
"""
DENSE = ("rating_sum", "final_rating")
RESTAURANTS_VIEW = """
    SELECT site, restaurant_id, latest.restaurant_name, latest.county, latest.cuisine,
           first_date, latest.last_date
    FROM (
        SELECT site, restaurant_id, min(first_date) AS first_date,
               max(struct(last_date, restaurant_name, county, cuisine)) AS latest
        FROM {rows} GROUP BY site, restaurant_id
    )
"""
IN_ONE_STATEMENT = 500

Spec = tuple[str, str, str]  # site, version, value


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def refresh(spark: SparkSession, name: str) -> None:
    """Let a table or view that outlives a write see the new files."""
    spark.catalog.refreshTable(name)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    if not spark.catalog.tableExists(name):
        return {}
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES `{name}`").collect()}


def ensure_table(spark: SparkSession, name: str, path: str, schema: StructType, *columns: str) -> None:
    """An external table over a folder, without partitions as yet; one that is there stays."""
    if spark.catalog.tableExists(name) and _properties(spark, name).get("tablepulse.path") != path:
        spark.sql(f"DROP TABLE `{name}`")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{name}` ({fields}) USING parquet "
        f"PARTITIONED BY ({', '.join(columns)}) LOCATION {_quoted(path)} "
        f"TBLPROPERTIES ('tablepulse.path' = {_quoted(path)})"
    )


def _alter_partitions(
    spark: SparkSession, name: str, change: str, column: str, specs: Iterable[Spec], between: str
) -> None:
    clauses = [
        f"PARTITION (site={_quoted(site)}, version={_quoted(version)}, {column}={_quoted(value)})"
        for site, version, value in sorted(specs)
    ]
    for at in range(0, len(clauses), IN_ONE_STATEMENT):
        spark.sql(f"ALTER TABLE `{name}` {change} {between.join(clauses[at : at + IN_ONE_STATEMENT])}")


def _specs(release: Release, fact: Fact) -> Iterator[Spec]:
    for (table, column, value), version in release.entries.items():
        if table == fact.table and column == fact.column:
            yield release.site.name, version, value


def _registered(spark: SparkSession, name: str, site: str) -> Iterator[Spec]:
    """What the catalogue lists for a site, where the list published before is gone."""
    for (row,) in spark.sql(f"SHOW PARTITIONS `{name}` PARTITION (site={_quoted(site)})").collect():
        parts = [part.split("=", 1)[1] for part in row.split("/")]
        yield parts[0], parts[1], parts[2]


def _published(spark: SparkSession, fact: Fact, name: str, site: Site, number: int) -> set[Spec]:
    if number in release_numbers(spark, site):
        return set(_specs(load_release(spark, site, number), fact))
    return set(_registered(spark, name, site.name))


def publish_warehouse(spark: SparkSession, root: str, prefix: str = "") -> dict[str, str]:
    """Publish the current releases of all sites below ``root``.

    The stored facts become external tables and the names the views over them:
    ``rating_sum``, ``final_rating``, ``grade_values`` and ``reviews`` with the
    restaurant's latest attributes joined on. The first three have every day of a series.
    Returns the names given.
    """
    root = root.rstrip("/")
    sites = released_sites(spark, root)
    releases = [release for site in sites if (release := current_release(spark, site)).entries]
    current = f"{prefix}current_partitions"
    names: dict[str, str] = {}
    stale: list[tuple[str, str, set[Spec]]] = []
    for fact in FACTS:
        wanted = {release.site.name: set(_specs(release, fact)) for release in releases}
        if not any(wanted.values()):
            continue
        facts = f"{prefix}{fact.name}_facts"
        schema = StructType(
            [*fact.schema.fields, *(StructField(name, StringType()) for name in ("site", "version"))]
        )
        ensure_table(spark, facts, f"{root}/{fact.table}", schema, "site", "version", fact.column)
        done = _properties(spark, facts)
        for release in releases:
            number = int(done.get(f"tablepulse.release.{release.site.name}", 0))
            before = _published(spark, fact, facts, release.site, number)
            new = wanted[release.site.name]
            _alter_partitions(spark, facts, "ADD IF NOT EXISTS", fact.column, new - before, " ")
            stale.append((facts, fact.column, before - new))
        names[fact.name] = f"{prefix}{fact.name}"

    if not releases:
        return {}
    lists = (f"SELECT * FROM json.`{list_file(r.site, r.number)}`" for r in releases)
    spark.sql(f"CREATE OR REPLACE VIEW `{current}` AS {' UNION ALL '.join(lists)}")
    for fact in FACTS:
        if fact.name not in names:
            continue
        facts, restaurants = f"{prefix}{fact.name}_facts", names["restaurants"]
        rows = CURRENT_ROWS.format(facts=facts, current=current, table=fact.table, column=fact.column)
        if fact.name == "restaurants":
            query = RESTAURANTS_VIEW.format(rows=rows)
        else:
            source = EVERY_DAY if fact.name in DENSE else STORED_ROWS
            joined = source.format(rows=rows, restaurants=restaurants, health=HEALTH_SITE)
            query = f"SELECT {VIEW_COLUMNS[fact.name]} FROM {joined}"
        if not spark.catalog.tableExists(names[fact.name]):
            spark.sql(f"CREATE VIEW `{names[fact.name]}` AS {query}")
    for facts, column, specs in stale:
        _alter_partitions(spark, facts, "DROP IF EXISTS", column, specs, ", ")
    for name in names:
        done = ", ".join(
            f"'tablepulse.release.{release.site.name}' = '{release.number}'" for release in releases
        )
        spark.sql(f"ALTER TABLE `{prefix}{name}_facts` SET TBLPROPERTIES ({done})")
    return names
