"""The bookmarked file stream: every file once, also after a failure."""

import glob
import os
import time

import pytest
from frames import HEALTH_ROWS, REVIEW_ROWS, expected_final_rating, raw_health, raw_reviews, review
from pyspark.sql import functions as F

from tablepulse import schemas
from tablepulse.__main__ import main
from tablepulse.layout import Site, health_site
from tablepulse.plans.health import read_grade_values
from tablepulse.plans.reviews import read_final_rating
from tablepulse.sources.readers import read_raw, stream_raw
from tablepulse.sources.releases import current_release, release_numbers
from tablepulse.streaming import bookmark
from tablepulse.streaming.bookmark import (
    backfill_landed_reviews,
    ingest_all_sites,
    ingest_new_health,
    ingest_new_reviews,
    run_new_files,
)


@pytest.fixture
def site(tmp_path):
    return Site(str(tmp_path), "yelp_reviews")


def land(spark, site, rows):
    raw_reviews(spark, rows).coalesce(1).write.mode("append").option("header", True).csv(site.landing)


def ratings(spark, site):
    got = read_final_rating(spark, site.root).collect()
    return {(r.restaurant_id, r.review_date): r.final_rating for r in got}


def expected(rows):
    return {key: value[2] for key, value in expected_final_rating(rows).items()}


def test_only_new_files_are_read(spark, site):
    land(spark, site, REVIEW_ROWS[:2])
    assert ingest_new_reviews(spark, site) == 1
    assert ingest_new_reviews(spark, site) == 0
    land(spark, site, REVIEW_ROWS[2:])
    assert ingest_new_reviews(spark, site) == 1
    assert ratings(spark, site) == expected(REVIEW_ROWS)


def test_old_modification_times_and_missing_folders(spark, site):
    for number, age in enumerate((0, 30 * 86400, 1)):
        land(spark, site, [review(f"k{number}", "20230501", "1", number + 1)])
        for path in glob.glob(f"{site.landing}/part-*"):
            os.utime(path, (time.time() - age,) * 2)
        assert ingest_new_reviews(spark, site) == 1
    stored = {row.review_id for row in current_release(spark, site).read("input_parquet", schemas.REVIEWS).collect()}
    assert stored == {"k0", "k1", "k2"}
    nowhere = Site(site.root, "unknown_reviews")
    assert ingest_all_sites(spark, [nowhere, site]) == [0, 0]
    assert not spark.streams.active


def land_as(spark, site, rows, *columns):
    raw = raw_reviews(spark, rows).select(*columns).coalesce(1)
    raw.write.mode("append").option("header", True).csv(site.landing)


def test_columns_go_by_name(spark, site):
    order = [*reversed(schemas.RAW_REVIEWS.names), F.lit("x").alias("app.version")]
    land_as(spark, site, REVIEW_ROWS, *order)
    known = raw_reviews(spark, REVIEW_ROWS).collect()
    got = read_raw(spark, site.landing, schemas.RAW_REVIEWS)
    assert got.columns == [*schemas.RAW_REVIEWS.names, "app.version", schemas.MALFORMED]
    assert sorted(tuple(row)[:-2] for row in got.collect()) == sorted(tuple(row) for row in known)
    assert got.select("rating").distinct().count() == len({row.rating for row in known})
    assert ingest_new_reviews(spark, site) == 1
    assert ratings(spark, site) == expected(REVIEW_ROWS)
    archived = read_raw(spark, site.history, schemas.RAW_REVIEWS)
    assert sorted(map(str, archived.collect())) == sorted(map(str, got.collect()))


def test_missing_and_misplaced_columns_fail(spark, site):
    names = schemas.RAW_REVIEWS.names
    land_as(spark, site, REVIEW_ROWS, *(name for name in names if name != "county"))
    with pytest.raises(ValueError, match="no column county"):
        read_raw(spark, site.landing, schemas.RAW_REVIEWS)
    with pytest.raises(ValueError, match="no column county"):
        ingest_new_reviews(spark, site)
    mixed = Site(site.root, "google_reviews")
    land(spark, mixed, REVIEW_ROWS)
    land_as(spark, mixed, REVIEW_ROWS, *reversed(names))
    with pytest.raises(Exception, match="header"):
        read_raw(spark, mixed.landing, schemas.RAW_REVIEWS).collect()
    with pytest.raises(Exception, match="header"):
        ingest_new_reviews(spark, mixed)
    assert current_release(spark, mixed).read("input_parquet", schemas.REVIEWS).count() == 0


def test_backfill_takes_its_files_as_seen(spark, site):
    land(spark, site, REVIEW_ROWS)
    backfill_landed_reviews(spark, site)
    assert ingest_new_reviews(spark, site) == 0
    late = review("k8", "20230504", "1", 1)
    land(spark, site, [late])
    assert ingest_new_reviews(spark, site) == 1
    assert ratings(spark, site) == expected([*REVIEW_ROWS, late])
    backfill_landed_reviews(spark, site)
    assert ratings(spark, site) == expected([*REVIEW_ROWS, late])


def test_files_per_batch_and_failure(spark, site):
    for number in range(3):
        land(spark, site, [review(f"k{number}", "20230501", "1", number + 1)])
    stream = lambda: stream_raw(spark, site.landing, schemas.RAW_REVIEWS, 1)
    seen = []

    def job(batch, key):
        if len(seen) == 1 and not failed:
            failed.append(key)
            raise RuntimeError("lost")
        seen.append((key, batch.count()))

    failed = []
    with pytest.raises(Exception, match="lost"):
        run_new_files(stream(), site.checkpoint, job)
    assert run_new_files(stream(), site.checkpoint, job) == 2
    assert [count for _, count in seen] == [1, 1, 1]
    assert seen[1][0] == failed[0]
    assert len({key for key, _ in seen}) == 3


def test_sites_side_by_side(spark, tmp_path):
    sites = [Site(str(tmp_path), name) for name in ("google_reviews", "yelp_reviews")]
    halves = REVIEW_ROWS[:3], REVIEW_ROWS[3:]
    for site, rows in zip(sites, halves):
        land(spark, site, rows)
    assert ingest_all_sites(spark, sites) == [1, 1]
    assert ingest_all_sites(spark, sites) == [0, 0]
    for site, rows in zip(sites, halves):
        got = read_final_rating(spark, site.root, [site.name]).collect()
        assert {(r.restaurant_id, r.review_date): r.final_rating for r in got} == expected(rows)


def test_one_failing_site_leaves_the_others(spark, tmp_path, monkeypatch):
    sites = [Site(str(tmp_path), name) for name in ("google_reviews", "yelp_reviews")]
    for site in sites:
        land(spark, site, REVIEW_ROWS)
    real = bookmark.ingest_reviews

    def sometimes(site, *args):
        if site.name == "google_reviews":
            raise RuntimeError("lost")
        real(site, *args)

    with monkeypatch.context() as patch:
        patch.setattr(bookmark, "ingest_reviews", sometimes)
        with pytest.raises(Exception, match="lost"):
            ingest_all_sites(spark, sites)
    assert ingest_all_sites(spark, sites) == [1, 0]
    assert read_final_rating(spark, str(tmp_path)).count() == 2 * len(expected(REVIEW_ROWS))


def test_quoted_text_survives(spark, site):
    row = list(review("k1", "20230501", "1", 4))
    row[7] = 'said "fine", twice'
    land(spark, site, [tuple(row)])
    ingest_new_reviews(spark, site)
    stored = current_release(spark, site).read("input_parquet", schemas.REVIEWS)
    assert stored.first().comments == row[7]


def test_health_stream(spark, tmp_path):
    site = health_site(str(tmp_path))
    for stamp, grade in (("20230501", "2"), ("20230504", "5")):
        raw_health(spark, [(stamp, "1", "n", "c", "b", grade)]).write.mode("append").option(
            "header", True
        ).csv(site.landing)
        assert ingest_new_health(spark, site) == 1
    got = read_grade_values(spark, site.root).orderBy("grade_date").collect()
    assert [r.health_grade for r in got] == [2, 2, 2, 5]


def test_jobs_by_command(spark, site):
    late = review("k9", "20230601", "1", 5)
    land(spark, site, REVIEW_ROWS)
    main(["backfill-reviews", "--root", site.root, "--site", site.name])
    assert ratings(spark, site) == expected(REVIEW_ROWS)
    land(spark, site, [review("k8", "20230504", "1", 1), late])
    main(
        ["ingest-reviews", "--root", site.root, "--site", site.name, "--max-files", "5"]
        + ["--latest", "2023-05-31"]
    )
    assert ratings(spark, site) == expected([*REVIEW_ROWS, review("k8", "20230504", "1", 1)])
    main(["publish", "--root", site.root, "--prefix", "cmd_"])
    assert spark.table("cmd_final_rating").count() == len(ratings(spark, site))
    raw_health(spark, HEALTH_ROWS).write.option("header", True).csv(health_site(site.root).landing)
    main(["ingest-health", "--root", site.root])
    before = ratings(spark, site), sorted(map(str, read_grade_values(spark, site.root).collect()))
    main(["upkeep", "--root", site.root, "--keep", "1"])
    assert release_numbers(spark, site) == [3] and len(before[1]) > 0
    after = ratings(spark, site), sorted(map(str, read_grade_values(spark, site.root).collect()))
    assert after == before
    assert len(current_release(spark, site).values("restaurants")) == 1
