"""Small hand-made inputs and plain-Python reference results."""

from collections import defaultdict
from datetime import date, timedelta

from tablepulse import schemas

REVIEW_ROWS = [
    ("a1", "20230501", "1", "North", "Bergen", "3", "x", "x", "add"),
    ("a2", "20230501", "1", "North", "Bergen", "4", "x", "x", "add"),
    ("a3", "20230503", "1", "North", "Bergen", "5", "x", "x", "add"),
    ("a4", "20230502", "2", "South", "Passaic", None, "x", "x", "add"),
    ("a5", "20230520", "2", "South", "Passaic", "2", "x", "x", "add"),
]
HEALTH_ROWS = [
    ("20230501", "1", "North", "Greek", "Bergen", "3"),
    ("20230505", "1", "North", "Greek", "Bergen", "4"),
    ("20230501", "2", "South", "Indian", "Passaic", "3"),
    ("20230506", "2", "South", "Indian", "Passaic", "3"),
]


def day(text):
    return date.fromisoformat(text)


def raw_reviews(spark, rows):
    """Rows as tuples in file order: id, date, restaurant, name, county, rating, ..."""
    return spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7], r[8]) for r in rows], schemas.RAW_REVIEWS
    )


def review(key, when, restaurant, rating, name=None, county="Bergen"):
    """One raw review; the name defaults to one per restaurant."""
    stamp = when if isinstance(when, str) else when.strftime("%Y%m%d")
    stars = None if rating is None else str(rating)
    return (key, stamp, restaurant, name or f"name-{restaurant}", county, stars, "x", "x", "add")


def raw_health(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_HEALTH)


def parse(stamp):
    return date(int(stamp[:4]), int(stamp[4:6]), int(stamp[6:]))


def expected_final_rating(rows, days=7):
    """{(restaurant, day): (sum, count, rating, name, county)} from distinct raw rows."""
    totals = defaultdict(lambda: [0, 0])
    latest = {}
    for r in set(rows):
        when = parse(r[1])
        cell = totals[r[2], when]
        if r[5] is not None:
            cell[0] += int(r[5])
            cell[1] += 1
        latest[r[2]] = max(latest.get(r[2], (date.min, "", "")), (when, r[3], r[4]))
    result = {}
    for restaurant in latest:
        active = [when for who, when in totals if who == restaurant]
        when = min(active)
        while when <= max(active):
            window = [totals.get((restaurant, when - timedelta(i)), (0, 0)) for i in range(days)]
            count = sum(c for _, c in window)
            rating = sum(s for s, _ in window) / count if count else None
            s, c = totals.get((restaurant, when), (0, 0))
            result[restaurant, when] = (s, c, rating, *latest[restaurant][1:])
            when += timedelta(1)
    return result


def expected_grades(rows):
    """{(restaurant, day): grade} from raw rows, highest grade of a day, carried forward."""
    grades = {}
    for r in rows:
        key = (r[1], parse(r[0]))
        known = [g for g in (grades.get(key), None if r[5] is None else int(r[5])) if g is not None]
        grades[key] = max(known) if known else None
    result = {}
    for restaurant in {who for who, _ in grades}:
        active = [when for who, when in grades if who == restaurant]
        when, grade = min(active), None
        while when <= max(active):
            found = grades.get((restaurant, when))
            grade = grade if found is None else found
            result[restaurant, when] = grade
            when += timedelta(1)
    return result
