"""Releases: all tables of a batch or none, whatever step a job is lost at."""

from datetime import date, timedelta

import pyarrow.parquet as pq
import pytest
from frames import HEALTH_ROWS, REVIEW_ROWS, expected_final_rating, raw_health, raw_reviews, review
from pyspark.sql import functions as F

from tablepulse import schemas
from tablepulse.layout import Site, health_site
from tablepulse.operators.rolling import rated_days
from tablepulse.plans.health import ingest_health, read_grade_runs
from tablepulse.plans.reviews import ingest_reviews, read_final_rating, read_rating_sum
from tablepulse.plans.upkeep import clean_releases
from tablepulse.sources import catalog
from tablepulse.sources.catalog import publish_warehouse
from tablepulse.sources.releases import (
    Release,
    current_release,
    names_in,
    read_released,
    release_numbers,
)

START = date(2023, 1, 1)


@pytest.fixture
def site(tmp_path):
    return Site(str(tmp_path), "google_reviews")


def state(spark, site):
    """All that a reader sees of a site."""
    ratings = read_final_rating(spark, site.root, [site.name])
    totals = read_rating_sum(spark, site.root, [site.name])
    reviews = current_release(spark, site).read("input_parquet", schemas.REVIEWS)
    return tuple(sorted(map(str, df.collect())) for df in (ratings, totals, reviews))


def ratings(spark, site):
    rows = read_final_rating(spark, site.root, [site.name]).collect()
    return {(r.restaurant_id, r.review_date): r.final_rating for r in rows}


def expected(rows):
    return {key: value[2] for key, value in expected_final_rating(rows).items()}


def test_job_lost_between_any_two_steps(spark, site, monkeypatch):
    known = [review("k1", START + timedelta(9), "1", 4), review("k2", START + timedelta(9), "2", 2)]
    new = [review("k3", START, "1", 1), review("k4", START + timedelta(18), "2", 5)]
    ingest_reviews(site, raw_reviews(spark, known), "b0")
    before = state(spark, site)
    steps = 0
    while True:
        done = []

        def step(name, real, limit=steps, done=done):
            def run(*args, **kwargs):
                if len(done) == limit:
                    raise RuntimeError(f"lost before {name}")
                done.append(name)
                return real(*args, **kwargs)

            return run

        with monkeypatch.context() as patch:
            patch.setattr(Release, "replace", step("replace", Release.replace))
            patch.setattr(Release, "commit", step("commit", Release.commit))
            try:
                ingest_reviews(site, raw_reviews(spark, new), "b1")
            except RuntimeError as error:
                assert "lost" in str(error)
                assert state(spark, site) == before
                steps += 1
                continue
        break
    assert steps == 6 and ratings(spark, site) == expected(known + new)


def test_lost_during_the_rename_of_the_list(spark, site):
    ingest_reviews(site, raw_reviews(spark, REVIEW_ROWS), "b0")
    before = state(spark, site)
    release = current_release(spark, site)
    empty = spark.createDataFrame([], schemas.FINAL_RATING)
    release.replace(empty, "final_rating", "review_date")
    with open(f"{site.releases}/.{release.version}", "w") as draft:
        draft.write(release.lines()[:20])  # written in part, never renamed
    assert state(spark, site) == before
    release.commit()
    assert current_release(spark, site).values("final_rating") == []


def test_second_job_of_a_site_fails(spark, site):
    ingest_reviews(site, raw_reviews(spark, REVIEW_ROWS), "b0")
    first, second = current_release(spark, site), current_release(spark, site)
    log = spark.createDataFrame([("9", "n", "c", START, START, "x")], schemas.REVIEW_RESTAURANTS)
    first.replace(log, "restaurants", "batch", ["x"])
    second.replace(log, "restaurants", "batch", ["x"])
    first.commit()
    seen = state(spark, site)
    with pytest.raises(RuntimeError, match="not published"):
        second.commit()
    assert state(spark, site) == seen and release_numbers(spark, site) == [1, 2]
    assert not [name for name in names_in(spark, site.releases) if name.startswith(f".{second.version}")]


def test_listed_partitions_without_rows_go(spark, site):
    release = current_release(spark, site)
    days = [START + timedelta(i) for i in range(3)]
    frame = spark.createDataFrame([("r", 1, 1, 1, day) for day in days], schemas.RATING_SUM)
    release.replace(frame, "rating_sum", "review_date")
    release.commit()
    release.replace(frame.where(F.col("review_date") == days[1]), "rating_sum", "review_date", days[1:])
    release.commit()
    stored = read_released(spark, site.root, "rating_sum", schemas.with_site(schemas.RATING_SUM))
    assert sorted(r.review_date for r in stored.collect()) == days[:2]
    between = read_released(
        spark, site.root, "rating_sum", schemas.RATING_SUM, between=(days[1], days[2])
    )
    assert [r.review_date for r in between.collect()] == [days[1]]
    assert len(between.inputFiles()) == 1
    nowhere = read_released(spark, f"{site.root}/none", "rating_sum", schemas.RATING_SUM)
    assert nowhere.collect() == [] and nowhere.schema == schemas.RATING_SUM


def test_values_with_special_characters(spark, site):
    release = current_release(spark, site)
    key = "run 1:a/b=c%'\u00e9"
    log = spark.createDataFrame([("9", "n", "c", START, START, key)], schemas.REVIEW_RESTAURANTS)
    assert release.replace(log, "restaurants", "batch", [key]) == [key]
    release.commit()
    again = current_release(spark, site)
    assert again.values("restaurants") == [key]
    (row,) = again.read("restaurants", schemas.REVIEW_RESTAURANTS).collect()
    assert row.batch == key


def test_clean_releases_keeps_what_is_read(spark, site):
    rows = [review(f"k{i}", START + timedelta(i), "1", 1 + i % 5) for i in range(6)]
    for number in range(4):
        ingest_reviews(site, raw_reviews(spark, rows[: number + 3]), f"b{number}")
    lost = current_release(spark, site)
    lost.replace(lost.read("rating_sum", schemas.RATING_SUM), "rating_sum", "review_date")
    reader = read_final_rating(spark, site.root)
    before = state(spark, site)
    assert clean_releases(spark, site) > 0
    assert state(spark, site) == before and reader.count() == 6
    assert release_numbers(spark, site) == [3, 4]
    assert lost.version not in str(names_in(spark, site.table("rating_sum")))
    assert clean_releases(spark, site) == 0
    ingest_reviews(site, raw_reviews(spark, rows), "b9")
    assert ratings(spark, site) == expected(rows)


def test_publishing_again_adds_what_the_batch_wrote(spark, site, monkeypatch):
    known = [review(f"k{i}", START + timedelta(i), "1", 1 + i % 5) for i in range(40)]
    ingest_reviews(site, raw_reviews(spark, known), "b0")
    prefix = "rel_"
    real, added, dropped = catalog._alter_partitions, [], []

    def alter(spark, name, change, column, specs, between):
        specs = list(specs)
        (added if change.startswith("ADD") else dropped).extend(specs)
        real(spark, name, change, column, specs, between)

    monkeypatch.setattr(catalog, "_alter_partitions", alter)
    names = publish_warehouse(spark, site.root, prefix)
    assert len(added) == 1 + 40 + 46 + 40 and not dropped
    view = spark.table(names["final_rating"])
    added.clear()
    new = [review("n1", START + timedelta(39), "1", 5)]
    ingest_reviews(site, raw_reviews(spark, new), "b1")
    # Readers see the release that was published last, however the folders change.
    assert view.where(F.col("review_date") > START + timedelta(39)).count() == 0
    shown = {r.review_date: r.rating_count for r in spark.table(names["final_rating"]).collect()}
    assert shown[START + timedelta(39)] == 1
    assert publish_warehouse(spark, site.root, prefix) == names
    assert {spec[2] for spec in added} == {"b1", *(str(START + timedelta(39 + i)) for i in range(7))}
    assert len(added) == 1 + 1 + 7 + 1 and len(dropped) == 9
    rows = spark.table(names["final_rating"]).collect()
    assert {(r.restaurant_id, r.review_date): r.final_rating for r in rows} == expected(known + new)
    added.clear(), dropped.clear()
    publish_warehouse(spark, site.root, prefix)
    assert not added and not dropped
    clean_releases(spark, site, keep=1)
    ingest_reviews(site, raw_reviews(spark, new), "b2")
    clean_releases(spark, site, keep=1)  # the list published before is gone
    publish_warehouse(spark, site.root, prefix)
    rows = spark.table(names["final_rating"]).collect()
    assert {(r.restaurant_id, r.review_date): r.final_rating for r in rows} == expected(known + new)


def test_a_batch_of_inspections_writes_the_runs_it_changes(spark, tmp_path):
    site = health_site(str(tmp_path))
    stamps = [START + timedelta(10 * i) for i in range(12)]
    rows = [
        (stamp.strftime("%Y%m%d"), str(who), "n", "c", "b", str(1 + (i + who) % 5))
        for i, stamp in enumerate(stamps)
        for who in range(3)
    ]
    ingest_health(site, raw_health(spark, rows), "b0")
    assert read_grade_runs(spark, site.root).count() == len(rows)
    before = current_release(spark, site).entries

    def written(batch, key):
        ingest_health(site, raw_health(spark, batch), key)
        now = current_release(spark, site).entries
        changed = {k[2] for k, v in now.items() if k[0] == "grade_runs" and before.get(k) != v}
        before.clear(), before.update(now)
        return changed

    late = stamps[4] + timedelta(3)
    assert written([(late.strftime("%Y%m%d"), "1", "n", "c", "b", "5")], "b1") == {
        str(stamps[4]),
        str(late),
    }
    assert written(rows[:5], "b2") == set()  # nothing new
    after = stamps[-1] + timedelta(1)
    assert written([(after.strftime("%Y%m%d"), "2", "n", "c", "b", None)], "b3") == {
        str(stamps[-1]),
        str(after),
    }
    runs = read_grade_runs(spark, site.root)
    assert runs.count() == len(rows) + 2
    (last,) = runs.where("restaurant_id = '2' and valid_to is null").collect()
    assert last.graded_on == stamps[-1] and last.valid_from == after


def test_one_restaurant_skips_row_groups(spark, site):
    """A date's rows are sorted by restaurant, so its statistics tell the groups apart."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.block.size", str(1 << 17))
    try:
        rows = spark.range(60_000).select(
            F.format_string("%06d", (F.col("id") * 7919) % 60_000).alias("restaurant_id"),
            F.col("id").alias("rating_sum"),
            F.lit(1).cast("long").alias("rating_count"),
            F.lit(START).alias("review_date"),
        )
        release = current_release(spark, site)
        release.replace(rated_days(rows, 1).select(schemas.FINAL_RATING.names), "final_rating", "review_date")
        release.commit()
    finally:
        settings.unset("parquet.block.size")
    stored = release.read("final_rating", schemas.FINAL_RATING)
    for path in stored.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        column = meta.schema.to_arrow_schema().names.index("restaurant_id")
        stats = [meta.row_group(i).column(column).statistics for i in range(meta.num_row_groups)]
        assert all(a.max <= b.min for a, b in zip(stats, stats[1:]))
    one = stored.where("restaurant_id = '000777'").select("rating_sum")
    assert one.count() == 1
    one.collect()
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() < 60_000 / 4


def test_series_of_named_restaurants(spark, site):
    rows = [review(f"k{i}", START + timedelta(i), str(i % 3), 3) for i in range(9)]
    ingest_reviews(site, raw_reviews(spark, rows), "b0")
    some = read_final_rating(spark, site.root, restaurant_ids=["1"])
    whole = read_final_rating(spark, site.root).where("restaurant_id = '1'")
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect())) and some.count() == 7
    assert "restaurant_id" in some._jdf.queryExecution().executedPlan().toString()


def test_health_and_reviews_are_separate_releases(spark, tmp_path):
    reviews, health = Site(str(tmp_path), "yelp_reviews"), health_site(str(tmp_path))
    ingest_health(health, raw_health(spark, HEALTH_ROWS), "b0")
    ingest_reviews(reviews, raw_reviews(spark, REVIEW_ROWS), "b0")
    assert release_numbers(spark, reviews) == release_numbers(spark, health) == [1]
    assert ratings(spark, reviews) == expected(REVIEW_ROWS)
