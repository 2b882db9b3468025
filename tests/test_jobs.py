"""Jobs over stored tables: incremental results equal a full load, and repeats change nothing."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from frames import (
    HEALTH_ROWS,
    REVIEW_ROWS,
    day,
    expected_final_rating,
    expected_grades,
    raw_health,
    raw_reviews,
    review,
)

from tablepulse import schemas
from tablepulse.layout import Site, health_site
from tablepulse.operators import insights
from tablepulse.operators.merge import union_all
from tablepulse.operators.normalize import normalize_reviews
from tablepulse.plans import reviews as review_jobs
from tablepulse.plans.health import ingest_health, read_grade_values, read_health_restaurants
from tablepulse.plans.reviews import (
    backfill_reviews,
    ingest_reviews,
    read_final_rating,
    read_rating_sum,
)
from tablepulse.plans.summaries import (
    read_cross_site_outliers,
    read_cuisine_site_counts,
    read_rating_profile,
)
from tablepulse.plans.upkeep import compact_restaurants
from tablepulse.queries import malformed_lines
from tablepulse.sources.catalog import publish_warehouse, refresh, register_view
from tablepulse.sources.readers import read_raw, tag_site
from tablepulse.sources.releases import current_release
from tablepulse.sources.writers import overwrite_partitions, replace_date_partitions, replace_table

START = date(2023, 1, 1)


@pytest.fixture
def site(tmp_path):
    return Site(str(tmp_path), "google_reviews")


def final_rating(spark, site):
    return {
        (r.restaurant_id, r.review_date): (
            r.rating_sum,
            r.rating_count,
            r.final_rating,
            r.restaurant_name,
            r.county,
        )
        for r in read_final_rating(spark, site.root, [site.name]).collect()
    }


def check(spark, site, rows):
    want = expected_final_rating(rows)
    assert read_final_rating(spark, site.root, [site.name]).count() == len(want)
    assert final_rating(spark, site) == want
    totals = {
        (r.restaurant_id, r.review_date): (r.rating_sum, r.rating_count)
        for r in read_rating_sum(spark, site.root, [site.name]).collect()
    }
    assert totals == {key: value[:2] for key, value in want.items()}


def stored(spark, site, table, schema):
    return current_release(spark, site).read(table, schema)


def folders(spark, site, table):
    return set(current_release(spark, site).folders(table))


def land(spark, site, rows):
    raw_reviews(spark, rows).write.mode("append").option("header", True).csv(site.landing)


def random_reviews(seed, n=24, restaurants=3, span=30):
    rng = random.Random(seed)
    return [
        review(
            f"k{i}",
            START + timedelta(rng.randrange(span)),
            str(rng.randrange(restaurants)),
            rng.choice([None, 1, 2, 3, 4, 5]),
            name=rng.choice(["Old", "New"]),
        )
        for i in range(n)
    ]


def test_backfill(spark, site):
    rows = [*REVIEW_ROWS, REVIEW_ROWS[0], review("bad", "2023xx01", "1", 3)]
    land(spark, site, rows)
    backfill_reviews(spark, site)
    check(spark, site, REVIEW_ROWS)
    assert stored(spark, site, "input_parquet", schemas.REVIEWS).count() == len(REVIEW_ROWS)
    rejects = spark.read.parquet(site.rejects).select("review_id", "review_date").collect()
    assert [tuple(r) for r in rejects] == [("bad", "2023xx01")]
    archived = read_raw(spark, site.history, schemas.RAW_REVIEWS)
    assert archived.count() == len(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_a_full_load(spark, site, seed):
    rows = random_reviews(seed)
    rng = random.Random(seed)
    rng.shuffle(rows)
    batches = [rows[:8], rows[6:16], rows[14:]]
    for number, batch in enumerate(batches):
        ingest_reviews(site, raw_reviews(spark, batch), f"b{number}")
        check(spark, site, [r for b in batches[: number + 1] for r in b])


def test_late_reviews_refresh_the_whole_window(spark, site):
    known = [review(f"k{i}", START + timedelta(i), "1", 1 + i % 5) for i in range(0, 31, 2)]
    ingest_reviews(site, raw_reviews(spark, known), "b0")
    late = [review(f"late{i}", START + timedelta(i), "1", 5) for i in (9, 18)]
    ingest_reviews(site, raw_reviews(spark, late), "b1")
    check(spark, site, known + late)


def test_reviews_outside_the_known_span(spark, site):
    known = [review("k1", START + timedelta(20), "1", 4), review("k2", START + timedelta(22), "2", 2)]
    ingest_reviews(site, raw_reviews(spark, known), "b0")
    outside = [review("k3", START, "1", 1), review("k4", START + timedelta(40), "2", 5)]
    ingest_reviews(site, raw_reviews(spark, outside), "b1")
    check(spark, site, known + outside)


def test_one_review_after_a_pause_rewrites_a_week(spark, site):
    known = [review("k1", START, "1", 4)]
    known += [review(f"d{i}", START + timedelta(i), "2", 1 + i % 5) for i in range(60)]
    ingest_reviews(site, raw_reviews(spark, known), "b0")

    tables = {"input_parquet": 1, "rating_sum": 1, "final_rating": 7}
    before = {table: folders(spark, site, table) for table in tables}
    late = [review("k2", START + timedelta(50), "1", 2)]
    ingest_reviews(site, raw_reviews(spark, late), "b1")
    check(spark, site, known + late)
    for table, most in tables.items():
        assert 1 <= len(folders(spark, site, table) - before[table]) <= most, table


def test_a_date_far_off_writes_a_week(spark, site):
    rows = [review("k1", START, "1", 4), review("k2", "02020101", "1", 2)]
    ingest_reviews(site, raw_reviews(spark, rows), "b0")
    rated = stored(spark, site, "final_rating", schemas.FINAL_RATING)
    assert rated.select("review_date").distinct().count() == 14
    between = (START - timedelta(2), START)
    got = read_final_rating(spark, site.root, [site.name], between).orderBy("review_date").collect()
    assert [(r.rating_count, r.final_rating) for r in got] == [(0, None), (0, None), (1, 4.0)]


def test_series_cut_to_a_range(spark, site):
    rows = random_reviews(5)
    ingest_reviews(site, raw_reviews(spark, rows), "b0")
    between = (START + timedelta(8), START + timedelta(17))
    want = {key: value for key, value in expected_final_rating(rows).items()
            if between[0] <= key[1] <= between[1]}
    ratings = read_final_rating(spark, site.root, (), between).collect()
    got = {(r.restaurant_id, r.review_date): r.final_rating for r in ratings}
    assert len(ratings) == len(want) and got == {key: value[2] for key, value in want.items()}
    totals = read_rating_sum(spark, site.root, (), between).collect()
    assert {(r.restaurant_id, r.review_date): r.rating_sum for r in totals} == {
        key: value[0] for key, value in want.items()
    }


def test_backfill_then_batches(spark, site):
    rows = random_reviews(7, span=14)
    land(spark, site, rows[:16])
    backfill_reviews(spark, site)
    ingest_reviews(site, raw_reviews(spark, rows[12:]), "b1")
    check(spark, site, rows)


def test_repeated_batch_changes_nothing(spark, site):
    rows = random_reviews(3, span=12)
    ingest_reviews(site, raw_reviews(spark, rows[:14]), "b0")
    for key in ("b1", "b1", "b2"):
        ingest_reviews(site, raw_reviews(spark, rows[10:]), key)
        check(spark, site, rows)
    assert stored(spark, site, "input_parquet", schemas.REVIEWS).count() == len(set(rows))


@pytest.mark.parametrize("stop_before", ["update_ratings", "rated_days"])
def test_batch_that_broke_off_is_completed(spark, site, monkeypatch, stop_before):
    """The job dies after the merge, or after ``rating_sum``, and the batch comes again."""
    known = [review("k1", START + timedelta(9), "1", 4), review("k2", START + timedelta(9), "2", 2)]
    new = [review("k3", START, "1", 1), review("k4", START + timedelta(18), "2", 5)]
    ingest_reviews(site, raw_reviews(spark, known), "b0")
    with monkeypatch.context() as patch:

        def die(*args, **kwargs):
            raise RuntimeError("lost")

        patch.setattr(review_jobs, stop_before, die)
        with pytest.raises(RuntimeError):
            ingest_reviews(site, raw_reviews(spark, new), "b1")
    ingest_reviews(site, raw_reviews(spark, new), "b1")
    check(spark, site, known + new)


def test_changed_review_is_another_row(spark, site):
    first, second = review("k1", START, "1", 1), review("k1", START, "1", 5)
    ingest_reviews(site, raw_reviews(spark, [first]), "b0")
    ingest_reviews(site, raw_reviews(spark, [second]), "b1")
    check(spark, site, [first, second])
    assert final_rating(spark, site)["1", START][:3] == (6, 2, 3.0)


def test_ids_and_rejects_of_a_batch(spark, site):
    rows = [review("k1", START, "00123", 3), review("k2", START, "abc", 4)]
    bad = [review("k3", "2023xx01", "1", 3)]
    report = ingest_reviews(site, raw_reviews(spark, rows + bad), "b0")
    assert report == ("b0", 3, 1, 1)
    check(spark, site, rows)
    assert spark.read.parquet(site.rejects).count() == 1
    ingest_reviews(site, raw_reviews(spark, bad), "b1")
    check(spark, site, rows)


def grades(spark, root):
    got = read_grade_values(spark, root).collect()
    result = {(r.restaurant_id, r.grade_date): r.health_grade for r in got}
    assert len(result) == len(got)
    return result


def test_health_files_in_sequence(spark, tmp_path):
    site = health_site(str(tmp_path))
    later = [("20230512", "1", "North", "Greek", "Bergen", "2"), ("20230509", "2", "S", "Thai", "P", "5")]
    earlier = [("20230428", "1", "North", "Greek", "Bergen", "5"), ("20230503", "2", "S", "I", "P", None)]
    done = []
    for number, batch in enumerate((HEALTH_ROWS, later, earlier, later)):
        ingest_health(site, raw_health(spark, batch), f"b{number}")
        done += batch
        assert grades(spark, site.root) == expected_grades(done)
    names = {r.restaurant_id: r.cuisine for r in read_health_restaurants(spark, site.root).collect()}
    assert names == {"1": "Greek", "2": "Thai"}


def test_random_health_batches(spark, tmp_path):
    rng = random.Random(9)
    site = health_site(str(tmp_path))
    rows = [
        (
            (START + timedelta(rng.randrange(20))).strftime("%Y%m%d"),
            str(rng.randrange(3)),
            "n",
            "c",
            "b",
            rng.choice([None, "1", "2", "5"]),
        )
        for _ in range(18)
    ]
    for number in range(3):
        ingest_health(site, raw_health(spark, rows[number * 6 : number * 6 + 6]), f"b{number}")
        assert grades(spark, site.root) == expected_grades(rows[: number * 6 + 6])


def test_replaced_dates_without_rows_lose_their_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [START + timedelta(i) for i in range(3)]
    schema = "n int, d date"
    replace_table(spark.createDataFrame([(i, d) for i, d in enumerate(days)], schema), path, "d")
    replace_date_partitions(spark.createDataFrame([(9, days[1])], schema), path, "d", days[1:])
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == [(0, days[0]), (9, days[1])]


def test_view_that_outlives_an_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda n: spark.createDataFrame([(n, START)], "n int, d date")
    overwrite_partitions(frame(1), path, "d")
    register_view(spark.read.parquet(path), "kept_view")
    assert spark.table("kept_view").first().n == 1
    overwrite_partitions(frame(2), path, "d")
    refresh(spark, "kept_view")
    assert spark.table("kept_view").first().n == 2


def test_published_tables(spark, tmp_path):
    root = str(tmp_path)
    site, health = Site(root, "yelp_reviews"), health_site(root)
    ingest_reviews(site, raw_reviews(spark, REVIEW_ROWS), "b0")
    ingest_health(health, raw_health(spark, HEALTH_ROWS), "b0")
    names = publish_warehouse(spark, root, "t1_")
    assert set(names) == {"restaurants", "rating_sum", "final_rating", "grade_values", "reviews"}
    kept = spark.table(names["reviews"])
    assert {r.site for r in kept.collect()} == {site.name}
    assert kept.count() == len(set(REVIEW_ROWS))
    rated = spark.table(names["final_rating"])
    want = read_final_rating(spark, root, [site.name]).select(rated.columns)
    assert {tuple(r) for r in rated.collect()} == {tuple(r) for r in want.collect()}
    assert rated.count() == 22
    got = spark.sql(
        f"SELECT f.restaurant_id, f.restaurant_name, g.cuisine, f.final_rating, g.health_grade "
        f"FROM {names['final_rating']} f JOIN {names['grade_values']} g "
        f"ON f.restaurant_id = g.restaurant_id AND f.review_date = g.grade_date "
        f"WHERE f.review_date = DATE'2023-05-03' ORDER BY 1"
    ).collect()
    assert [tuple(r) for r in got] == [
        ("1", "North", "Greek", 4.0, 3),
        ("2", "South", "Indian", None, 3),
    ]
    new = [review("k9", day("2023-05-04"), "1", 5, "North")]
    ingest_reviews(site, raw_reviews(spark, new), "b1")
    names = publish_warehouse(spark, root, "t1_")
    assert spark.table(names["final_rating"]).where("restaurant_id = '1'").count() == 4


def test_compacted_restaurants(spark, site):
    rows = random_reviews(4, n=12, span=10)
    ingest_reviews(site, raw_reviews(spark, rows[:4]), "b0")
    ingest_reviews(site, raw_reviews(spark, rows[4:8]), "b1")
    compact_restaurants(spark, site)
    assert len(folders(spark, site, "restaurants")) == 1
    ingest_reviews(site, raw_reviews(spark, rows[8:]), "b2")
    check(spark, site, rows)


def test_implausible_dates_are_rejected(spark, site):
    rows = [review("k1", START, "1", 3), review("k2", date(1023, 1, 1), "1", 3)]
    rows.append(review("k3", "bad", "1", 3))
    raw = raw_reviews(spark, rows)
    ingest_reviews(site, raw, "b0", plausible=(date(2000, 1, 1), date(2100, 1, 1)))
    check(spark, site, rows[:1])
    assert spark.read.parquet(site.rejects).count() == 2


def test_malformed_lines_reach_the_rejects(spark, site):
    header = ",".join(schemas.RAW_REVIEWS.names)
    good = "k1,20230105,1,North,Bergen,4,x,x,add"
    bad = [
        "k2,20230105,1",
        'k3,20230105,1,North,Bergen,4,x,"never closed,add',
        "k4,20230105,1,North,Bergen,4,x,x,add,more,fields",
    ]
    os.makedirs(site.landing)
    with open(f"{site.landing}/part-0.csv", "w") as file:
        file.write("\n".join([header, good, *bad]) + "\n")
    backfill_reviews(spark, site)
    kept = stored(spark, site, "input_parquet", schemas.REVIEWS)
    assert [r.review_id for r in kept.collect()] == ["k1"]
    rejects = spark.read.parquet(site.rejects)
    assert sorted(r._malformed for r in rejects.collect()) == sorted(bad)
    raw = read_raw(spark, site.landing, schemas.RAW_REVIEWS)
    report = ingest_reviews(site, raw, "b1")
    assert (report.rows, report.rejected) == (4, 3)
    assert sorted(r._malformed for r in spark.read.parquet(f"{site.rejects}/batch=b1").collect()) == sorted(bad)
    archived = spark.read.option("header", True).csv(f"{site.history}/batch=b1")
    assert archived.columns == schemas.RAW_REVIEWS.names and archived.count() == 4


def test_cut_off_lines_have_a_header_in_every_file(spark, tmp_path):
    """Without broadcasts the rows come from shuffles, in any order beside a header row."""
    noon = "timestamp_ntz'2024-01-05 12:00:00'"
    spark.range(40).selectExpr(
        "id event_id", f"{noon} - make_interval(0, 0, 0, 0, int(id % 3)) ts", "id % 7 user_id",
        "'view' event_type", "double(id) value", "'p' props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(7).selectExpr(
        "id c_custkey", "'c' c_name", "int(id % 2) c_nationkey", "0D c_acctbal", "'m' c_mktsegment"
    ).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(2).selectExpr("int(id) n_nationkey", "'n' n_name", "0 n_regionkey").write.parquet(
        f"{tmp_path}/nation.parquet"
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = malformed_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(str(at), f"{at},20240105") for at in range(40) if at % 3]
    assert sorted(map(tuple, got)) == sorted(want)


def test_summaries_follow_the_batches(spark, tmp_path):
    """Totals and histograms, kept by batches, give what all reviews give, for any dates."""
    root = str(tmp_path)
    sites = [Site(root, name) for name in ("google_reviews", "yelp_reviews")]
    every = []
    for number, one in enumerate(sites):
        rows = random_reviews(20 + number, n=40)
        ingest_reviews(one, raw_reviews(spark, rows[:25]), "b0")
        ingest_reviews(one, raw_reviews(spark, rows[15:]), "b1")
        every.append(tag_site(normalize_reviews(raw_reviews(spark, sorted(set(rows), key=str))), one.name))
    ingest_health(health_site(root), raw_health(spark, HEALTH_ROWS), "b0")
    reviews = union_all(*every)
    cuisines = read_health_restaurants(spark, root)
    for between in (None, (START + timedelta(5), START + timedelta(12))):
        some = reviews if between is None else reviews.where(F.col("review_date").between(*map(F.lit, between)))
        pairs = [
            (insights.cuisine_site_counts(some, cuisines), read_cuisine_site_counts(spark, root, between)),
            (
                insights.cross_site_outliers(some, 0.5),
                read_cross_site_outliers(spark, root, 0.5, between),
            ),
        ]
        for want, got in pairs:
            assert sorted(map(str, want.collect())) == sorted(map(str, got.collect()))
        profile = insights.column_profile(some, "rating").collect()
        want = {r.summary: None if r.rating is None else float(r.rating) for r in profile}
        got = {r.statistic: r.rating for r in read_rating_profile(spark, root, (), between).collect()}
        assert got == pytest.approx(want)
    nothing = read_rating_profile(spark, root, (), (date(1990, 1, 1), date(1990, 1, 2))).collect()
    assert {r.statistic: r.rating for r in nothing}["count"] == 0
