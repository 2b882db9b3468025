"""The registered queries as SQL over the sample tables, for checking results."""

from __future__ import annotations

_BASE = """
restaurants AS (
    SELECT CAST(c_custkey AS VARCHAR) AS restaurant_id, c_name AS restaurant_name,
           n_name AS county, c_mktsegment AS cuisine
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
all_reviews AS (
    SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS restaurant_id,
           CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INTEGER) AS rating,
           'masked' AS reviewer_name, props AS comments, 'add' AS operation,
           CAST(ts AS DATE) AS review_date, coalesce(hour(ts), 0) AS posted_hour,
           CASE event_type WHEN 'view' THEN 'google_reviews' WHEN 'click' THEN 'yelp_reviews'
                WHEN 'purchase' THEN 'purchase_reviews' ELSE 'other_reviews' END AS site
    FROM events WHERE event_type IS DISTINCT FROM 'signup'
),
named_reviews AS (SELECT * FROM all_reviews LEFT JOIN restaurants USING (restaurant_id)),
health AS (
    SELECT CAST(user_id AS VARCHAR) AS restaurant_id, CAST(ts AS DATE) AS grade_date,
           CAST(CAST(floor(value) AS BIGINT) % 5 + 1 AS INTEGER) AS health_grade
    FROM events WHERE event_type = 'signup'
),
daily_grade AS (
    SELECT restaurant_id, grade_date, max(health_grade) AS health_grade FROM health GROUP BY ALL
),
grade_calendar AS (
    SELECT restaurant_id, CAST(unnest(generate_series(min(grade_date), max(grade_date),
           INTERVAL 1 DAY)) AS DATE) AS grade_date
    FROM daily_grade GROUP BY restaurant_id
),
grades AS (
    SELECT restaurant_id, grade_date,
           last_value(health_grade IGNORE NULLS) OVER (
               PARTITION BY restaurant_id ORDER BY grade_date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS health_grade
    FROM grade_calendar LEFT JOIN daily_grade USING (restaurant_id, grade_date)
)"""


def _timeline(name: str, reviews: str, keys: str = "site, restaurant_id") -> str:
    """CTEs that end in ``name``: the dense rolling series per ``keys``."""
    return f"""
{name}_daily AS (
    SELECT {keys}, review_date, CAST(sum(rating) AS BIGINT) AS rating_sum,
           count(rating) AS rating_count
    FROM {reviews} GROUP BY ALL
),
{name}_calendar AS (
    SELECT {keys}, CAST(unnest(generate_series(min(review_date), max(review_date),
           INTERVAL 1 DAY)) AS DATE) AS review_date
    FROM {name}_daily GROUP BY {keys}
),
{name}_dense AS (
    SELECT {keys}, review_date, coalesce(rating_sum, 0) AS rating_sum,
           coalesce(rating_count, 0) AS rating_count
    FROM {name}_calendar LEFT JOIN {name}_daily USING ({keys}, review_date)
),
{name} AS (
    SELECT *, CAST(sum(rating_sum) OVER recent AS DOUBLE)
              / nullif(CAST(sum(rating_count) OVER recent AS DOUBLE), 0) AS final_rating
    FROM {name}_dense
    WINDOW recent AS (PARTITION BY {keys} ORDER BY review_date
                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
)"""


def _with(query: str, *ctes: str) -> str:
    return "WITH " + ",".join((_BASE, *ctes)) + "\n" + query


_REVIEW = (
    "review_id, restaurant_id, restaurant_name, county, rating, reviewer_name, comments, "
    "operation, review_date"
)
_SERIES = "restaurant_id, restaurant_name, county, review_date, rating_sum, rating_count, final_rating"
_FACTS = "restaurant_id, rating_sum, rating_count, final_rating, review_date"
_IS_WEEKEND = "dayofweek(review_date) IN (0, 6)"

_ALL_REVIEWS = f"SELECT {_REVIEW} FROM named_reviews WHERE TRUE"
_RATED = _timeline("rated", "all_reviews")
_POOLED = _timeline("pooled", "all_reviews", "restaurant_id")
_NAMED_SERIES = (
    f"SELECT {_SERIES} FROM pooled LEFT JOIN restaurants USING (restaurant_id)"
)
_FINAL_RATING = (
    f"SELECT site, {_SERIES} FROM rated LEFT JOIN restaurants USING (restaurant_id)"
)
_REPLACED = _with(
    f"SELECT {_FACTS} FROM morning WHERE NOT ({_IS_WEEKEND}) "
    f"UNION ALL SELECT {_FACTS} FROM pooled WHERE {_IS_WEEKEND}",
    _POOLED,
    _timeline(
        "morning",
        "(SELECT * FROM all_reviews WHERE posted_hour < 12)",
        "restaurant_id",
    ),
)
_GRADE_VALUES = _with(
    "SELECT restaurant_id, grade_date, restaurant_name, cuisine, health_grade "
    "FROM grades LEFT JOIN restaurants USING (restaurant_id)"
)


def _correlation(keys: str) -> str:
    return _with(
        f"""SELECT {keys.replace("rated.", "")}, n_days, CASE WHEN r = 0 THEN 0 ELSE r END AS r FROM (
    SELECT {keys}, count(*) AS n_days,
           round(covar_pop(final_rating, health_grade)
                 / nullif(stddev_pop(final_rating) * stddev_pop(health_grade), 0), 6) AS r
    FROM rated JOIN grades ON rated.restaurant_id = grades.restaurant_id
                          AND review_date = grade_date
    WHERE final_rating IS NOT NULL AND health_grade IS NOT NULL
    GROUP BY {keys})""",
        _RATED,
    )


ORACLES: dict[str, str] = {
    "raw_csv_roundtrip": _with(_ALL_REVIEWS),
    "raw_history": _with(
        "SELECT review_id, strftime(review_date, '%Y%m%d') AS review_date, restaurant_id, "
        "restaurant_name, county, rating, reviewer_name, comments, operation, "
        "CAST(posted_hour AS INTEGER) AS posted_hour FROM named_reviews"
    ),
    "bookmark_ingest": _with(_ALL_REVIEWS),
    "site_tagged_reviews": _with(
        "SELECT review_id, restaurant_id, rating, review_date, site FROM all_reviews"
    ),
    "pruned_dates": _with(f"{_ALL_REVIEWS} AND {_IS_WEEKEND}"),
    "excluded_dates": _with(f"{_ALL_REVIEWS} AND NOT ({_IS_WEEKEND})"),
    "appended_grades": _with("SELECT restaurant_id, health_grade, grade_date FROM health"),
    "cast_project": _with(
        "SELECT grade_date, restaurant_id, restaurant_name, cuisine, health_grade "
        "FROM health LEFT JOIN restaurants USING (restaurant_id)"
    ),
    "daily_rating": _with(
        "SELECT restaurant_id, restaurant_name, county, review_date, "
        "CAST(sum(rating) AS BIGINT) AS rating_sum, count(rating) AS rating_count "
        f"FROM named_reviews GROUP BY ALL"
    ),
    "active_span": _with(
        "SELECT restaurant_id, restaurant_name, county, min(review_date) AS first_date, "
        f"max(review_date) AS last_date FROM named_reviews GROUP BY ALL"
    ),
    "restaurant_attributes": _with(
        f"""SELECT restaurant_id, restaurant_name, county, first_date, last_date FROM (
            SELECT restaurant_id, restaurant_name, county,
                   min(review_date) OVER (PARTITION BY restaurant_id) AS first_date,
                   max(review_date) OVER (PARTITION BY restaurant_id) AS last_date,
                   row_number() OVER (PARTITION BY restaurant_id
                       ORDER BY review_date DESC, restaurant_name DESC, county DESC) AS place
            FROM named_reviews) WHERE place = 1"""
    ),
    "distinct_reviews": _with(_ALL_REVIEWS),
    "touched_dates": _with(
        f"SELECT review_date, count(*) AS n_rows FROM all_reviews GROUP BY ALL"
    ),
    "row_counts": _with("SELECT site, count(*) AS n_rows FROM all_reviews GROUP BY ALL"),
    "rating_profile": _with(
        f"""SELECT unnest(['count', 'mean', 'stddev', 'min', '25%', '50%', '75%', 'max'])
                   AS statistic,
               unnest([count(rating), round(avg(rating), 6), round(stddev_samp(rating), 6),
                   min(rating), quantile_disc(rating, 0.25), quantile_disc(rating, 0.5),
                   quantile_disc(rating, 0.75), max(rating)]::DOUBLE[]) AS rating
        FROM all_reviews"""
    ),
    "date_sequence": _with(
        "SELECT restaurant_id, restaurant_name, county, review_date FROM rated_calendar",
        _timeline(
            "rated",
            "named_reviews",
            "restaurant_id, restaurant_name, county",
        ),
    ),
    "calendar_join": _with(
        f"""SELECT restaurant_id, c.review_date, coalesce(rating_sum, 0) AS rating_sum,
               coalesce(rating_count, 0) AS rating_count
        FROM pooled_calendar c LEFT JOIN pooled_daily USING (restaurant_id, review_date)""",
        _POOLED,
    ),
    "grade_calendar_join": _with(
        "SELECT restaurant_id, grade_date, CAST(health_grade AS DOUBLE) AS health_grade "
        "FROM grade_calendar LEFT JOIN daily_grade USING (restaurant_id, grade_date)"
    ),
    "densify": _with(
        "SELECT restaurant_id, review_date, rating_sum, rating_count "
        "FROM pooled_dense",
        _POOLED,
    ),
    "rolling_rating": _with(_NAMED_SERIES, _POOLED),
    "shipment_timeline": "WITH shipped AS (SELECT CAST(l_suppkey AS VARCHAR) AS restaurant_id, "
    "CAST(l_shipdate AS DATE) AS review_date, CAST(floor(l_quantity) AS BIGINT) % 5 + 1 AS rating "
    "FROM lineitem),"
    + _timeline("rated", "shipped", "restaurant_id")
    + "\nSELECT restaurant_id, review_date, rating_sum, rating_count, final_rating FROM rated",
    "ordered_head": _with(f"{_NAMED_SERIES} ORDER BY restaurant_id, review_date LIMIT 20", _POOLED),
    "ordered_tail": _with(
        f"{_NAMED_SERIES} ORDER BY restaurant_id DESC, review_date DESC LIMIT 5", _POOLED
    ),
    "forward_fill_grades": _GRADE_VALUES,
    "merge_partitions": _with(_ALL_REVIEWS),
    "affected_dates": _with(
        f"""SELECT review_date, bool_or(reach = 0) AS is_touched,
               bool_or(reach BETWEEN 0 AND 6) AS is_output
        FROM (SELECT CAST(review_date + r.reach AS DATE) AS review_date, r.reach
              FROM (SELECT DISTINCT review_date FROM all_reviews
                    WHERE {_IS_WEEKEND}),
                   (SELECT CAST(unnest(range(-6, 7)) AS INTEGER) AS reach) r)
        GROUP BY ALL"""
    ),
    "replace_dates": _REPLACED,
    "replaced_dates_in_memory": _REPLACED,
    "backfill_reviews": _with(_FINAL_RATING, _RATED),
    "incremental_reviews": _with(_FINAL_RATING, _RATED),
    "ingest_health": _GRADE_VALUES,
    "grade_runs": _with(
        """SELECT restaurant_id, grade_date AS valid_from,
               CAST(lead(grade_date) OVER series - 1 AS DATE) AS valid_to,
               last_value(health_grade IGNORE NULLS) OVER so_far AS health_grade,
               last_value(CASE WHEN health_grade IS NOT NULL THEN grade_date END IGNORE NULLS)
                   OVER so_far AS graded_on
        FROM daily_grade
        WINDOW series AS (PARTITION BY restaurant_id ORDER BY grade_date),
               so_far AS (PARTITION BY restaurant_id ORDER BY grade_date
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    ),
    "uncommitted_batch": _with(
        f"SELECT site, {_SERIES} FROM morning LEFT JOIN restaurants USING (restaurant_id)",
        _timeline(
            "morning",
            "(SELECT * FROM all_reviews WHERE posted_hour < 12 AND site = 'google_reviews')",
        ),
    ),
    "graded_ratings": _with(
        """SELECT rated.site, rated.restaurant_id, review_date, final_rating, health_grade
        FROM rated JOIN grades ON rated.restaurant_id = grades.restaurant_id
                              AND review_date = grade_date
        WHERE final_rating IS NOT NULL""",
        _RATED,
    ),
    "republished_ratings": _with(
        """SELECT county, count(*) AS n_days, CAST(sum(rating_count) AS BIGINT) AS n_reviews,
               max(final_rating) AS best_rating
        FROM rated LEFT JOIN restaurants USING (restaurant_id)
        WHERE site = 'google_reviews' GROUP BY county""",
        _RATED,
    ),
    "rating_hygiene_corr": _correlation("site"),
    "summed_hygiene_corr": _correlation("site"),
    "rating_hygiene_corr_by_restaurant": _correlation("site, rated.restaurant_id"),
    "quality_timeline": _with(
        """SELECT coalesce(rated.restaurant_id, grades.restaurant_id) AS restaurant_id,
               coalesce(review_date, grade_date) AS "day", site, final_rating,
               CAST(health_grade AS DOUBLE) AS health_grade
        FROM rated FULL OUTER JOIN grades ON rated.restaurant_id = grades.restaurant_id
                                         AND review_date = grade_date""",
        _RATED,
    ),
    "cuisine_site_counts": _with(
        "SELECT cuisine, site, count(*) AS n_reviews FROM named_reviews GROUP BY ALL"
    ),
    "cross_site_outliers": _with(
        """SELECT *, abs(site_mean - overall_mean) >= 0.5 AS is_outlier FROM (
            SELECT restaurant_id, site, rating_count, rating_sum / nullif(rating_count, 0) AS site_mean,
                   sum(rating_sum) OVER w / nullif(sum(rating_count) OVER w, 0) AS overall_mean
            FROM (SELECT restaurant_id, site, CAST(sum(rating) AS DOUBLE) AS rating_sum,
                         count(rating) AS rating_count FROM all_reviews GROUP BY ALL)
            WINDOW w AS (PARTITION BY restaurant_id)
        )""".replace("SELECT *, abs", "SELECT restaurant_id, site, rating_count, site_mean, overall_mean, abs")
    ),
    "published_sql": _with(
        """SELECT site, county, count(*) AS n_days, CAST(sum(rating_count) AS BIGINT) AS n_reviews,
               max(final_rating) AS best_rating
        FROM rated LEFT JOIN restaurants USING (restaurant_id) GROUP BY site, county""",
        _RATED,
    ),
    "published_cuisine_counts": _with(
        """SELECT cuisine, site, count(*) AS n_reviews
        FROM (SELECT DISTINCT * EXCLUDE (posted_hour) FROM all_reviews
              WHERE review_date IS NOT NULL AND restaurant_id IS NOT NULL)
        LEFT JOIN (SELECT DISTINCT restaurant_id, cuisine FROM restaurants
                   JOIN health USING (restaurant_id) WHERE grade_date IS NOT NULL)
        USING (restaurant_id) GROUP BY cuisine, site"""
    ),
}

# The same results from stored totals.
ORACLES |= {
    "stored_cuisine_counts": ORACLES["published_cuisine_counts"],
    "stored_outliers": ORACLES["cross_site_outliers"],
    "stored_rating_profile": ORACLES["rating_profile"],
    "malformed_lines": _with(
        "SELECT review_id, review_id || ',' || strftime(review_date, '%Y%m%d') AS line "
        "FROM all_reviews WHERE posted_hour < 12"
    ),
}
