"""DuckDB text of the churn inputs and of the feature table, written row by row and join by join: an
independent second statement of what the Spark jobs compute in another shape."""

from __future__ import annotations

from ebbtide.schemas import HORIZONS, MEASURES, feature_name, holiday_feature

ACTIVITY = """
activity AS (
  SELECT o_custkey AS ID,
         CAST(date_trunc('week', o_orderdate) AS DATE) AS start_date_of_week,
         CAST(extract('week' FROM date_trunc('week', o_orderdate)) AS SMALLINT) AS week,
         CAST(extract('year' FROM date_trunc('week', o_orderdate)) AS INT) AS year,
         CAST(count(DISTINCT l_partkey) AS INT) AS unique_lots_viewed,
         CAST(count(*) AS INT) AS amount_views,
         CAST(count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_partkey END) AS INT) AS bidded_on_amount_lots,
         CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS INT) AS bids_places,
         round(sum(CASE WHEN l_discount > 0.05 THEN l_extendedprice ELSE 0 END), 2) AS total_bidded,
         round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 2) AS money_spend,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) AS amount_lots_won,
         min(c_mktsegment) AS platform
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  GROUP BY o_custkey, date_trunc('week', o_orderdate))"""

RAW_ATTRIBUTES = """
raw_attributes AS (
  SELECT c_custkey AS ID,
         CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'iPhone'
              WHEN c_custkey % 3 = 1 THEN 'Android' ELSE 'iPad' END AS mobile_device,
         n_name AS country,
         CASE n_regionkey WHEN 0 THEN 'EN' WHEN 1 THEN 'NL' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' ELSE 'IT' END
           AS preferred_language,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         c_mktsegment IN ('MACHINERY', 'BUILDING') AS is_company
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

ATTRIBUTES = RAW_ATTRIBUTES + """,
attributes AS (
  SELECT ID, coalesce(lower(mobile_device), 'unknown') AS mobile_device, lower(country) AS country,
         lower(preferred_language) AS preferred_language, lower(gender) AS gender, is_company
  FROM raw_attributes)"""

HOLIDAYS = """
holidays AS (
  SELECT lower(n_name) AS country, CAST(concat(y, d) AS DATE) AS holiday
  FROM nation, (VALUES ('1995'), ('1996'), ('1997'), ('1998'), ('1999'), ('2000'), ('2001')) AS years(y),
       (VALUES ('-01-01'), ('-05-01'), ('-12-25'), ('-12-26')) AS days(d)
  WHERE n_nationkey < 20)"""

# The holiday count in its long shape: number the rows, join every holiday of the row's country, flag, sum.
COUNTED = """
numbered AS (
  SELECT row_number() OVER () AS idx, activity.*, country
  FROM activity LEFT JOIN attributes USING (ID)),
flagged AS (
  SELECT numbered.idx, sum(CASE WHEN holiday BETWEEN start_date_of_week AND start_date_of_week + 6
                                THEN 1 ELSE 0 END) AS holiday_count
  FROM holidays LEFT JOIN numbered ON holidays.country = numbered.country
  GROUP BY numbered.idx),
counted AS (
  SELECT numbered.*, CAST(coalesce(flagged.holiday_count, 0) AS BIGINT) AS holiday_count
  FROM numbered JOIN flagged ON numbered.idx = flagged.idx)"""

LABEL = """
last_weeks AS (SELECT ID, max(start_date_of_week) AS last_activity FROM activity GROUP BY ID),
label AS (
  SELECT ID, CASE WHEN date_diff('day', last_activity, (SELECT max(last_activity) FROM last_weeks)) > 365
                  THEN TRUE ELSE FALSE END AS churned
  FROM last_weeks)"""

# round() keeps the comparison free of the summation order; cents divided by a week count stay exact at 6 digits.
DIGITS = 6


def statistics(days: int | None) -> list[str]:
    calls = [("average", "avg"), ("min", "min"), ("max", "max"), ("median", "median"), ("sum", "sum")]
    return [
        f"{call}({m}) AS {feature_name(m, s, days)}" for s, call in calls for m in MEASURES
    ]


def lifetime(source: str) -> str:
    return (
        f"SELECT ID, count(start_date_of_week) AS num_of_active_weeks, "
        f"date_diff('day', min(start_date_of_week), max(start_date_of_week)) AS days_subscribed, "
        f"{', '.join(statistics(None))} FROM {source} GROUP BY ID"
    )


def horizon(source: str, days: int) -> str:
    return (
        f"SELECT ID, {', '.join(statistics(days))}, sum(holiday_count) AS {holiday_feature(days)} "
        f"FROM {source} WHERE date_diff('day', start_date_of_week, last_activity) <= {days} GROUP BY ID"
    )


def feature_ctes(horizons: list[int] = HORIZONS) -> str:
    """``features``: lifetime aggregates left-joined with one filtered aggregate per horizon."""
    parts = [
        "dated AS (SELECT counted.*, m.last_activity FROM counted LEFT JOIN "
        "(SELECT ID, max(start_date_of_week) AS last_activity FROM counted GROUP BY ID) m USING (ID))",
        f"lifetime AS ({lifetime('counted')})",
    ]
    parts += [f"h{d} AS ({horizon('dated', d)})" for d in horizons]
    joins = " ".join(f"LEFT JOIN h{d} USING (ID)" for d in horizons)
    parts.append(f"features AS (SELECT * FROM lifetime {joins})")
    return ",\n".join(parts)


def rounded(name: str) -> str:
    return f"round(CAST(coalesce({name}, 0) AS DOUBLE), {DIGITS}) AS {name}"


INPUTS = ",".join(["WITH " + ACTIVITY, ATTRIBUTES, HOLIDAYS, COUNTED])
