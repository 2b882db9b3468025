"""Releases: the tables of a site change together or not at all.

A job writes the partitions it replaces into new folders,
``<root>/<table>/site=<site>/version=<version>/<column>=<value>/``, which no reader looks
at. A release is the list of all partitions of the site's tables with the version of
each. It becomes current when its list appears, by one rename, under the next number;
readers take the list with the greatest number. A job that is lost at any point before
leaves the release before it as it was, and its next run writes another version.

The driver handles one line a partition, never a row or a file. Listing follows what is
read: the partitions of three dates are three folders, however many the table has.
One job at a time may change a site; a second one fails at its commit. Old versions stay
readable until ``plans.upkeep.clean_releases`` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablepulse.layout import Site

Partition = tuple[str, str, str]  # table, column, value
# Files keep a Bloom filter of this column, besides being sorted by it.
CLUSTERED = "restaurant_id"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder; nothing if there is none."""
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(_path(spark, path)))


def _escaped(spark: SparkSession, value: str) -> str:
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog
    return catalog.ExternalCatalogUtils.escapePathName(value)


def _unescaped(spark: SparkSession, value: str) -> str:
    catalog = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog
    return catalog.ExternalCatalogUtils.unescapePathName(value)


def _text(value: str | date) -> str:
    return value.isoformat() if isinstance(value, date) else str(value)


@dataclass
class Release:
    """The partitions of a site's tables. ``version`` names the folders of what a job replaces."""

    spark: SparkSession
    site: Site
    number: int = 0
    entries: dict[Partition, str] = field(default_factory=dict)
    version: str = ""

    def __post_init__(self) -> None:
        self.version = f"{self.number + 1:08d}-{uuid.uuid4().hex[:8]}"

    def values(self, table: str) -> list[str]:
        """The partition values of a table."""
        return [value for name, _, value in self.entries if name == table]

    def folders(self, table: str, values: Iterable[str | date] | None = None) -> Iterator[str]:
        wanted = None if values is None else {_text(value) for value in values}
        base = self.site.table(table)
        for (name, column, value), version in self.entries.items():
            if name == table and (wanted is None or value in wanted):
                yield f"{base}/version={version}/{column}={_escaped(self.spark, value)}"

    def read(
        self, table: str, schema: StructType, values: Iterable[str | date] | None = None
    ) -> DataFrame:
        """A table as it is in this release, or those of its partitions that are listed."""
        return read_folders(self.spark, self.site.root, table, schema, self.folders(table, values))

    def replace(
        self,
        df: DataFrame,
        table: str,
        column: str,
        values: Iterable[str | date] | None = None,
        clustered_by: str | None = CLUSTERED,
    ) -> list[str]:
        """Make ``df`` the content of the listed partitions, or of the whole table.

        A listed partition without rows goes. The rows of a partition are sorted by
        ``clustered_by``, so that statistics and Bloom filters tell which row groups hold
        a restaurant. ``df`` may read the same table: other folders are written.
        Returns the values that have rows.
        """
        folder = f"{self.site.table(table)}/version={self.version}"
        rows = df.hint("rebalance", column)
        writer = rows.write
        if clustered_by:
            writer = rows.sortWithinPartitions(column, clustered_by).write
            writer = writer.option(f"parquet.bloom.filter.enabled#{clustered_by}", "true")
        writer.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            column
        ).parquet(folder)
        prefix = f"{column}="
        names = names_in(self.spark, folder)
        found = [_unescaped(self.spark, x[len(prefix) :]) for x in names if x.startswith(prefix)]
        gone = self.values(table) if values is None else [_text(value) for value in values]
        for value in gone:
            self.entries.pop((table, column, value), None)
        self.entries.update({(table, column, value): self.version for value in found})
        return found

    def lines(self) -> str:
        """The list as text, one JSON object a partition."""
        keys = ("table", "column", "value", "version", "site")
        rows = [(*key, version, self.site.name) for key, version in sorted(self.entries.items())]
        return "".join(json.dumps(dict(zip(keys, row, strict=True))) + "\n" for row in rows)

    def commit(self) -> None:
        """Publish all replaced partitions at once."""
        jvm = self.spark.sparkContext._jvm
        target = _path(self.spark, list_file(self.site, self.number + 1))
        draft = _path(self.spark, f"{self.site.releases}/.{self.version}")
        files = _files(self.spark, self.site.releases)
        files.mkdirs(_path(self.spark, self.site.releases))
        stream = files.create(draft, True)
        try:
            stream.write(self.lines().encode())
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        modes = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(modes, 1)
        options[0] = modes.NONE
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as error:
            files.delete(draft, False)
            raise RuntimeError(
                f"release {self.number + 1} of {self.site.name} was not published; another job may have done so"
            ) from error
        self.number += 1
        self.__post_init__()


def list_file(site: Site, number: int) -> str:
    return f"{site.releases}/{number:08d}.json"


def release_numbers(spark: SparkSession, site: Site) -> list[int]:
    names = names_in(spark, site.releases)
    return [int(name[:8]) for name in names if name.endswith(".json") and not name.startswith(".")]


def load_release(spark: SparkSession, site: Site, number: int) -> Release:
    """A release that was committed; number 0 is the one without tables."""
    if not number:
        return Release(spark, site)
    rows = spark.read.text(list_file(site, number)).collect()  # one line a partition
    lines = [json.loads(row[0]) for row in rows]
    entries = {(line["table"], line["column"], line["value"]): line["version"] for line in lines}
    return Release(spark, site, number, entries)


def current_release(spark: SparkSession, site: Site) -> Release:
    """What readers see now, and what a job starts from."""
    return load_release(spark, site, max(release_numbers(spark, site), default=0))


def released_sites(spark: SparkSession, root: str) -> list[Site]:
    """The sites that have a release."""
    prefix = "site="
    names = names_in(spark, f"{root.rstrip('/')}/_releases")
    sites = [Site(root, name[len(prefix) :]) for name in names if name.startswith(prefix)]
    return [site for site in sites if release_numbers(spark, site)]


def read_folders(
    spark: SparkSession, root: str, table: str, schema: StructType, folders: Iterable[str]
) -> DataFrame:
    """Partition folders of a table; an empty frame where there are none."""
    paths = list(folders)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/{table}")
    return reader.parquet(*paths).select(*schema.names)


def read_released(
    spark: SparkSession,
    root: str,
    table: str,
    schema: StructType,
    sites: Iterable[str] = (),
    between: tuple[date, date] | None = None,
) -> DataFrame:
    """A table of all sites, or of those named, in one scan; ``between`` picks its partitions."""
    chosen = set(sites)
    folders: list[str] = []
    for site in released_sites(spark, root):
        if chosen and site.name not in chosen:
            continue
        release = current_release(spark, site)
        values = release.values(table)
        if between:
            first, last = (_text(bound) for bound in between)
            values = [value for value in values if first <= value <= last]
        folders += release.folders(table, values)
    return read_folders(spark, root, table, schema, folders)


def used_folders(spark: SparkSession, site: Site, numbers: Iterable[int]) -> set[str]:
    """Every partition folder that the given releases read."""
    releases = [load_release(spark, site, number) for number in numbers]
    tables = {key[0] for release in releases for key in release.entries}
    return {path for release in releases for table in tables for path in release.folders(table)}
