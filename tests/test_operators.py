"""Operators on hand-made frames."""

import random
from datetime import date, timedelta

import pytest
from frames import HEALTH_ROWS, REVIEW_ROWS, day, expected_grades, parse, raw_health, raw_reviews, review
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tablepulse.functions import parse_compact_date, ratio
from tablepulse.operators import insights
from tablepulse.operators.affected import affected_dates
from tablepulse.operators.asof import as_of_join
from tablepulse.operators.calendar import daily_calendar, densify, join_calendar
from tablepulse.operators.grades import (
    daily_grade,
    days_of_runs,
    forward_fill,
    forward_fill_grades,
    grade_runs,
    updated_runs,
)
from tablepulse.operators.merge import (
    in_dates,
    merge_partitions,
    not_in_dates,
    replace_dates,
    set_union,
)
from tablepulse.operators.normalize import normalize_health, normalize_reviews, rejected, usable
from tablepulse.operators.rolling import rated_days, rating_timeline, rolling_rating
from tablepulse.operators.rollups import (
    active_span,
    daily_rating,
    merge_restaurants,
    restaurants,
    touched_dates,
)

ZERO = {"rating_sum": 0, "rating_count": 0}


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def reviews(spark):
    return normalize_reviews(raw_reviews(spark, REVIEW_ROWS)).cache()


def test_compact_date(spark):
    df = spark.createDataFrame([("20230501",), ("2023xx01",), ("20230230",), (None,)], "d string")
    assert rows(df.select(parse_compact_date("d"))) == [(day("2023-05-01"),), (None,), (None,), (None,)]
    number = spark.createDataFrame([(20230501,)], "d int")
    assert rows(number.select(parse_compact_date("d"))) == [(day("2023-05-01"),)]
    with pytest.raises(PySparkException):
        df.select(parse_compact_date("d", strict=True)).collect()


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(3, 2), (0, 0), (1, 0)], "a long, b long")
    assert rows(df.select(ratio("a", "b"))) == [(1.5,), (None,), (None,)]


def test_ids_stay_text(spark):
    raw = raw_reviews(spark, [review("k1", "20230501", "00123", 3), review("k2", "20230501", "abc", 4)])
    typed = normalize_reviews(raw)
    assert rows(typed.select("restaurant_id"), "restaurant_id") == [("00123",), ("abc",)]


def test_rejects(spark):
    raw = raw_reviews(
        spark,
        [
            review("ok", "20230501", "1", 3),
            review("bad date", "2023xx01", "1", 3),
            review("no id", "20230501", None, 3),
            review("bad rating", "20230501", "1", "many"),
        ],
    )
    assert rows(rejected(raw, "review_date").select("review_id", "review_date"), "review_id") == [
        ("bad date", "2023xx01"),
        ("no id", "20230501"),
    ]
    good = normalize_reviews(raw).where(usable("review_date"))
    assert rows(good.select("review_id", "rating"), "review_id") == [("bad rating", None), ("ok", 3)]


def test_daily_rating(reviews):
    assert rows(daily_rating(reviews), "restaurant_id", "review_date") == [
        ("1", "North", "Bergen", day("2023-05-01"), 7, 2),
        ("1", "North", "Bergen", day("2023-05-03"), 5, 1),
        ("2", "South", "Passaic", day("2023-05-02"), None, 0),
        ("2", "South", "Passaic", day("2023-05-20"), 2, 1),
    ]


def test_span_and_touched_dates(spark, reviews):
    assert rows(active_span(reviews), "restaurant_id") == [
        ("1", day("2023-05-01"), day("2023-05-03")),
        ("2", day("2023-05-02"), day("2023-05-20")),
    ]
    assert rows(touched_dates(reviews), "review_date")[0] == (day("2023-05-01"), 2)
    flagged = reviews.withColumn("ok", F.col("rating").isNotNull())
    assert rows(touched_dates(flagged, "review_date", "ok"), "review_date")[1] == (
        day("2023-05-02"),
        1,
        0,
    )


def test_restaurants_keep_latest_attributes(spark):
    raw = [
        review("1", "20230501", "1", 3, "Old", "Bergen"),
        review("2", "20230504", "1", 3, "New", "Passaic"),
        review("3", "20230504", "1", 3, "Newer", "Bergen"),
        review("4", "20230503", "1", 3, "Zeta", "Bergen"),
    ]
    whole = restaurants(normalize_reviews(raw_reviews(spark, raw)))
    want = [("1", "Newer", "Bergen", day("2023-05-01"), day("2023-05-04"))]
    assert rows(whole) == want
    parts = restaurants(normalize_reviews(raw_reviews(spark, raw[:2]))).unionByName(
        restaurants(normalize_reviews(raw_reviews(spark, raw[2:])))
    )
    assert rows(merge_restaurants(parts.unionByName(parts))) == want


def test_timeline_on_the_sample(reviews):
    got = rows(rating_timeline(reviews), "restaurant_id", "review_date")
    assert [r[1:] for r in got if r[0] == "1"] == [
        (day("2023-05-01"), 7, 2, 3.5),
        (day("2023-05-02"), 0, 0, 3.5),
        (day("2023-05-03"), 5, 1, 4.0),
    ]
    second = [r for r in got if r[0] == "2"]
    assert len(second) == 19
    assert {r[4] for r in second[:-1]} == {None}
    assert second[-1][1:] == (day("2023-05-20"), 2, 1, 2.0)


def test_rename_keeps_one_series(spark):
    raw = [review("1", "20230501", "1", 2, "Old"), review("2", "20230503", "1", 4, "New")]
    got = rows(rating_timeline(normalize_reviews(raw_reviews(spark, raw))), "review_date")
    assert got == [
        ("1", day("2023-05-01"), 2, 1, 2.0),
        ("1", day("2023-05-02"), 0, 0, 2.0),
        ("1", day("2023-05-03"), 4, 1, 3.0),
    ]


def test_rolling_window_length(spark):
    start = date(2023, 1, 1)
    facts = spark.createDataFrame(
        [("1", start + timedelta(i), i + 1, 1) for i in range(10)],
        "restaurant_id string, review_date date, rating_sum long, rating_count long",
    )
    got = [r.final_rating for r in rolling_rating(facts).orderBy("review_date").collect()]
    assert got == [sum(range(max(1, i - 6), i + 1)) / min(i, 7) for i in range(1, 11)]
    short = [r.final_rating for r in rolling_rating(facts, 2).orderBy("review_date").collect()]
    assert short == [1.0] + [i - 0.5 for i in range(2, 11)]


def test_rated_days_are_the_informed_days_of_the_timeline(spark):
    random.seed(4)
    start = date(2024, 2, 20)
    facts = spark.createDataFrame(
        [
            ("r", str(random.randrange(5)), start + timedelta(random.randrange(90)), stars)
            for stars in [None, 1, 2, 3, 4, 5] * 8
        ],
        "review_id string, restaurant_id string, review_date date, rating int",
    )
    dense = rating_timeline(facts)
    reviewed = {(r[0], r[1]) for r in facts.select("restaurant_id", "review_date").collect()}
    informed = {(who, when + timedelta(i)) for who, when in reviewed for i in range(7)}
    got = rated_days(daily_rating(facts, ("restaurant_id",))).select(dense.columns)
    stored = {(r.restaurant_id, r.review_date): r for r in got.collect()}
    assert got.count() == len(stored) and set(stored) == informed
    for row in dense.collect():
        key = row.restaurant_id, row.review_date
        if key in stored:
            assert stored[key] == row
        else:
            assert (row.rating_sum, row.rating_count, row.final_rating) == (0, 0, None)
    within = rated_days(daily_rating(facts, ("restaurant_id",)), beyond=False).select(dense.columns)
    kept = {(r.restaurant_id, r.review_date): r for r in within.collect()}
    span = {(r.restaurant_id, r.review_date) for r in dense.collect()}
    assert kept == {key: row for key, row in stored.items() if key in span}


def test_densify_equals_the_calendar_join(spark):
    random.seed(3)
    start = date(2024, 2, 20)
    keys = {(str(random.randrange(12)), start + timedelta(random.randrange(60))) for _ in range(120)}
    facts = spark.createDataFrame(
        [(r, d, random.choice([None, 1, 5]), 1) for r, d in sorted(keys)],
        "restaurant_id string, review_date date, rating_sum long, rating_count long",
    )
    joined = join_calendar(
        daily_calendar(facts, ["restaurant_id"], "review_date"),
        facts,
        ["restaurant_id", "review_date"],
        ZERO,
    ).select(facts.columns)
    spread = densify(facts, ["restaurant_id"], "review_date", ZERO)
    order = ("restaurant_id", "review_date")
    assert rows(spread, *order) == rows(joined, *order)
    assert spread.schema["rating_sum"].dataType == facts.schema["rating_sum"].dataType

    unfilled = densify(facts, ["restaurant_id"], "review_date")
    calendar = daily_calendar(facts, ["restaurant_id"], "review_date")
    plain = join_calendar(calendar, facts, ["restaurant_id", "review_date"]).select(facts.columns)
    assert rows(unfilled, *order) == rows(plain, *order)

    low, high = start + timedelta(20), start + timedelta(30)
    clipped = densify(facts, ["restaurant_id"], "review_date", ZERO, only=(low, high))
    assert rows(clipped, *order) == [r for r in rows(spread, *order) if low <= r[1] <= high]


def test_densify_options(spark):
    facts = spark.createDataFrame(
        [("1", day("2023-01-01"), 4, "a"), ("1", day("2023-01-03"), 5, "b"), ("1", None, 9, "c")],
        "k string, d date, kept long, blank string",
    )
    got = densify(facts, ["k"], "d", carry=["kept"], until=day("2023-01-05"))
    assert rows(got, "d") == [
        ("1", day("2023-01-01"), 4, "a"),
        ("1", day("2023-01-02"), 4, None),
        ("1", day("2023-01-03"), 5, "b"),
        ("1", day("2023-01-04"), 5, None),
        ("1", day("2023-01-05"), 5, None),
    ]


def test_densify_keeps_several_rows_of_a_day(spark):
    facts = spark.createDataFrame(
        [("1", day("2023-01-01"), 4), ("1", day("2023-01-01"), 5), ("1", day("2023-01-03"), 6)],
        "k string, d date, v long",
    )
    got = rows(densify(facts, ["k"], "d", {"v": 0}), "d", "v")
    assert got == [
        ("1", day("2023-01-01"), 4),
        ("1", day("2023-01-01"), 5),
        ("1", day("2023-01-02"), 0),
        ("1", day("2023-01-03"), 6),
    ]


def test_grades_on_the_sample(spark):
    got = rows(
        forward_fill_grades(normalize_health(raw_health(spark, HEALTH_ROWS))),
        "restaurant_id",
        "grade_date",
    )
    assert [r[2] for r in got if r[0] == "1"] == [3, 3, 3, 3, 4]
    assert [r[2] for r in got if r[0] == "2"] == [3] * 6


def test_grades_with_nulls_and_several_per_day(spark):
    raw = [
        ("20230501", "1", "n", "c", "b", None),
        ("20230503", "1", "n", "c", "b", "2"),
        ("20230503", "1", "n", "c", "b", "4"),
        ("20230505", "1", "n", "c", "b", "none"),
        ("20230507", "1", "n", "c", "b", "1"),
    ]
    health = normalize_health(raw_health(spark, raw))
    got = {(r[0], r[1]): r[2] for r in rows(forward_fill_grades(health))}
    clean = [r if r[5] != "none" else (*r[:5], None) for r in raw]
    assert got == expected_grades(clean)
    assert rows(daily_grade(health), "grade_date")[1][2] == 4


def test_forward_fill(spark):
    df = spark.createDataFrame(
        [("1", 1, None), ("1", 2, 5), ("1", 3, None), ("2", 1, None)], "k string, t int, v int"
    )
    got = rows(forward_fill(df, ["k"], "t", "v"), "k", "t")
    assert [r[2] for r in got] == [None, 5, 5, None]


def run_rows(df):
    return sorted(
        ((r.restaurant_id, r.valid_from, r.valid_to, r.health_grade, r.graded_on) for r in df.collect()),
        key=lambda row: row[:2],
    )


def test_grade_runs_hold_every_day(spark):
    random.seed(12)
    raw = [
        ((date(2023, 1, 1) + timedelta(random.randrange(60))).strftime("%Y%m%d"),
         str(random.randrange(4)), "n", "c", "b", random.choice([None, "1", "3", "5"]))
        for _ in range(40)
    ]
    health = normalize_health(raw_health(spark, raw))
    runs = grade_runs(health)
    assert runs.count() == daily_grade(health).count()
    got = days_of_runs(runs).collect()
    assert {(r.restaurant_id, r.grade_date): r.health_grade for r in got} == expected_grades(raw)
    assert len(got) == len(expected_grades(raw))


def test_updated_runs_equal_a_recomputation(spark):
    random.seed(11)
    start = date(2023, 1, 1)
    for _ in range(5):
        raw = [
            (
                (start + timedelta(random.randrange(40))).strftime("%Y%m%d"),
                str(random.randrange(3)),
                "n",
                "c",
                "b",
                random.choice([None, "1", "3", "5"]),
            )
            for _ in range(14)
        ]
        cut = random.randrange(1, 14)
        before = grade_runs(normalize_health(raw_health(spark, raw[:cut])))
        after = run_rows(grade_runs(normalize_health(raw_health(spark, raw))))
        batch = normalize_health(raw_health(spark, raw[cut:]))
        first = min(parse(row[0]) for row in raw[cut:])
        near = before.where(
            (F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit(first - timedelta(1))))
            & F.col("restaurant_id").isin([row[1] for row in raw[cut:]])
        )
        changed = run_rows(updated_runs(near, batch, first))
        known = run_rows(before)
        assert sorted(set(after) - set(known)) == sorted(changed)
        stored = {row[:2]: row for row in known} | {row[:2]: row for row in changed}
        assert sorted(stored.values(), key=lambda row: row[:2]) == after


def test_as_of_join_equals_the_join_of_days(spark):
    random.seed(13)
    start = date(2023, 1, 1)
    events = [
        (random.choice(["1", "2", "3", None]), random.choice(["s", "t"]),
         random.choice([None, *(start + timedelta(i) for i in range(40))]), i)
        for i in range(200)
    ]
    intervals, cover = [], {}
    for key in ("1", "2", "4", None):
        at = start + timedelta(5)
        while at < start + timedelta(30):
            last = at + timedelta(random.randrange(6))
            grade = random.choice([None, 1, 5])
            intervals.append((key, at, last, grade))
            cover |= {(key, at + timedelta(i)): grade for i in range((last - at).days + 1)}
            at = last + timedelta(random.randrange(1, 4))
    left = spark.createDataFrame(events, "k string, site string, d date, n int")
    right = spark.createDataFrame(intervals, "k string, first date, last date, grade int")
    joined = as_of_join(left, right, ["k"], "d", "first", F.col("last"), ["grade"])
    want = [(*e, cover[e[0], e[2]]) for e in events if e[0] and e[2] and (e[0], e[2]) in cover]
    assert sorted(map(tuple, joined.collect()), key=lambda r: r[3]) == sorted(want, key=lambda r: r[3])
    assert joined.columns == ["k", "site", "d", "n", "grade"] and want


def test_date_filters(spark):
    df = spark.createDataFrame(
        [(1, day("2023-01-01")), (2, day("2023-01-02")), (3, None)], "n int, d date"
    )
    listed = [day("2023-01-01")]
    framed = spark.createDataFrame([(listed[0],)], "d date")
    for dates in (listed, framed):
        assert rows(in_dates(df, "d", dates).select("n")) == [(1,)]
        assert rows(not_in_dates(df, "d", dates).select("n")) == [(2,)]
        assert rows(not_in_dates(df, "d", dates, keep_null=True).select("n"), "n") == [(2,), (3,)]
        new = spark.createDataFrame([(9, listed[0])], "n int, d date")
        assert rows(replace_dates(df, new, "d", dates).select("n"), "n") == [(2,), (3,), (9,)]


def test_dates_before_the_year_1000(spark):
    old = [date(1, 1, 1), date(999, 5, 5)]
    df = spark.createDataFrame([(d,) for d in [*old, date(2023, 1, 1)]], "d date")
    assert in_dates(df, "d", old).count() == 2
    assert in_dates(df, "d", [date(900 + i, 1, 1) for i in range(40)]).count() == 0
    one = spark.createDataFrame([("1", date(999, 5, 5), 1)], "k string, d date, v int")
    assert densify(one, ["k"], "d", only=(date(1, 1, 1), date(9999, 12, 31))).count() == 1


def test_merge_is_a_set_union_of_touched_dates(spark, reviews):
    changed = normalize_reviews(
        raw_reviews(spark, [REVIEW_ROWS[0], (*REVIEW_ROWS[0][:5], "5", "x", "x", "add")])
    )
    merged = merge_partitions(reviews, changed, "review_date", [day("2023-05-01")])
    assert rows(merged.select("review_id", "rating"), "review_id", "rating") == [
        ("a1", 3),
        ("a1", 5),
        ("a2", 4),
    ]
    assert set_union(reviews, reviews).count() == 5


def test_merge_of_distinct_rows_equals_the_set_union(spark):
    random.seed(8)
    some = lambda: (
        random.choice([None, "a", "b"]),
        random.choice([None, 1, 2]),
        date(2023, 1, random.randrange(1, 4)),
    )
    schema = "review_id string, rating int, review_date date"
    for _ in range(3):
        stored = spark.createDataFrame({some() for _ in range(9)}, schema)
        batch = spark.createDataFrame([some() for _ in range(14)], schema)
        days = [date(2023, 1, 1), date(2023, 1, 2)]
        batch = in_dates(batch, "review_date", days)
        order = ("review_date", "review_id", "rating")
        plain = rows(merge_partitions(stored, batch, "review_date", days), *order)
        matched = merge_partitions(stored, batch, "review_date", days, match_on="review_id")
        assert rows(matched, *order) == plain


def test_affected_dates_against_sets(spark):
    touched = {date(2023, 1, 1), date(2023, 1, 2), date(2023, 2, 10)}
    frame = spark.createDataFrame([(d,) for d in touched] * 2, "review_date date")
    got = {r.review_date: (r.is_touched, r.is_output) for r in affected_dates(frame, 7).collect()}
    output = {d + timedelta(i) for d in touched for i in range(7)}
    needed = {d - timedelta(i) for d in output for i in range(7)}
    assert got == {d: (d in touched, d in output) for d in needed}


def test_correlation(spark):
    ratings = [("s", "1", date(2023, 1, i), float(i)) for i in range(1, 6)]
    ratings += [("s", "2", date(2023, 1, i), float(i)) for i in range(1, 6)]
    ratings += [("t", "3", date(2023, 1, 1), None)]
    runs = [("1", date(2023, 1, i), date(2023, 1, i), 6 - i) for i in range(1, 5)]
    runs += [("1", date(2023, 1, 5), None, 1)]
    runs += [("2", date(2023, 1, 1), date(2023, 1, 4), 3), ("2", date(2023, 1, 5), None, 3)]
    runs += [("3", date(2023, 1, 1), None, 3)]
    rated = spark.createDataFrame(
        ratings, "site string, restaurant_id string, review_date date, final_rating double"
    )
    graded = spark.createDataFrame(
        runs, "restaurant_id string, valid_from date, valid_to date, health_grade int"
    )
    each = insights.rating_hygiene_correlation(rated, graded, per_restaurant=True)
    got = {r.restaurant_id: (r.n_days, r.r) for r in each.collect()}
    assert got["1"][1] == pytest.approx(-1.0)
    assert got["2"] == (5, None)
    assert "3" not in got


def test_quality_timeline_range(spark):
    rated = spark.createDataFrame(
        [("s", "1", date(2023, 1, i), 3.0) for i in (1, 2, 3)],
        "site string, restaurant_id string, review_date date, final_rating double",
    )
    graded = spark.createDataFrame(
        [("1", date(2023, 1, i), 4) for i in (2, 3, 4)],
        "restaurant_id string, grade_date date, health_grade int",
    )
    whole = rows(insights.quality_timeline(rated, graded), "day")
    assert [r[1].day for r in whole] == [1, 2, 3, 4]
    part = insights.quality_timeline(rated, graded, date(2023, 1, 3), date(2023, 1, 4))
    assert rows(part, "day") == [
        ("1", date(2023, 1, 3), "s", 3.0, 4),
        ("1", date(2023, 1, 4), None, None, 4),
    ]


def test_site_insights(spark):
    tagged = spark.createDataFrame(
        [("1", "s", 5), ("1", "s", 5), ("1", "t", 1), ("2", "s", 3), ("2", "t", 3), ("9", "t", None)],
        "restaurant_id string, site string, rating int",
    )
    cuisines = spark.createDataFrame([("1", "Greek"), ("2", "Greek")], "restaurant_id string, cuisine string")
    counts = rows(insights.cuisine_site_counts(tagged, cuisines), "cuisine", "site")
    assert counts == [(None, "t", 1), ("Greek", "s", 3), ("Greek", "t", 2)]
    got = {(r[0], r[1]): r[5] for r in rows(insights.cross_site_outliers(tagged, 1.5))}
    assert got == {
        ("1", "s"): False,
        ("1", "t"): True,
        ("2", "s"): False,
        ("2", "t"): False,
        ("9", "t"): None,
    }


def test_head_and_tail(spark):
    df = spark.range(10)
    assert rows(insights.head(df, 3, "id")) == [(0,), (1,), (2,)]
    assert rows(insights.tail(df, 2, "id")) == [(9,), (8,)]


def test_summed_correlation_follows_replaced_days(spark):
    kind = "site string, restaurant_id string, review_date date, final_rating double"
    days = [date(2023, 1, i) for i in range(1, 9)]
    first = [
        (site, str(who), day, 1.0 + (3 * at + who * (site == "a")) % 5 / 1.5)
        for site in "ab" for who in (1, 2) for at, day in enumerate(days)
    ]
    first += [("flat", "1", day, 10 / 3) for day in days]
    late = {days[2], days[6], days[7]}
    second = [(s, r, d, x if s == "flat" else x / 2 + (d.day % 3)) for s, r, d, x in first if d in late]
    runs = spark.createDataFrame(
        [("1", days[0], days[3], 2), ("1", days[4], None, 4), ("2", days[1], None, 3)],
        "restaurant_id string, valid_from date, valid_to date, health_grade int",
    )
    new, old = spark.createDataFrame(second, kind), spark.createDataFrame(first, kind)
    stored = insights.correlation_sums(old, runs)
    for part in ([days[7]], [days[6], days[2]]):
        changed = insights.correlation_sums(new.where(new.review_date.isin(part)), runs)
        stored = replace_dates(stored, changed, "review_date", part)
    whole = spark.createDataFrame([r for r in first if r[2] not in late] + second, kind)
    want = {r.site: r for r in insights.rating_hygiene_correlation(whole, runs).collect()}
    got = {r.site: r for r in insights.correlation_of_sums(stored).collect()}
    assert set(got) == set(want) == {"a", "b", "flat"} and got["flat"].r is None
    assert all(got[s].n_days == want[s].n_days for s in want)
    assert all(got[s].r == pytest.approx(want[s].r, abs=1e-9) for s in "ab")
