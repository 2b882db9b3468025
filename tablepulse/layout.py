"""Where the tables of a warehouse lie.

``<root>/<table>/site=<site>/version=<version>/<date column>=.../``: the site is a
partition column of every table, so a query over all sites is one scan and a job for
one site writes below its own folder only. Which versions count is said by the site's
releases, see ``sources.releases``. Landed files, their archive and rejects have no
versions.
"""

from __future__ import annotations

from dataclasses import dataclass

HEALTH_SITE = "health_grade"

# Tables of a release.
INPUT = "input_parquet"
RESTAURANTS = "restaurants"
RATING_SUM = "rating_sum"
FINAL_RATING = "final_rating"
GRADE_RUNS = "grade_runs"
RATING_HISTOGRAM = "rating_histogram"


@dataclass(frozen=True)
class Site:
    """The folders of one review site (or of the health department)."""

    root: str
    name: str

    def table(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}/site={self.name}"

    @property
    def landing(self) -> str:
        return self.table("raw_data")

    @property
    def history(self) -> str:
        return self.table("raw_data_history")

    @property
    def rejects(self) -> str:
        return self.table("rejects")

    @property
    def checkpoint(self) -> str:
        return self.table("_checkpoints")

    @property
    def releases(self) -> str:
        return self.table("_releases")


def health_site(root: str) -> Site:
    return Site(root, HEALTH_SITE)
