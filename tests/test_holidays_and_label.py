from __future__ import annotations

import datetime as dt
import random

import builders as b

from ebbtide.operators.holidays import add_holiday_counts, holiday_dimension
from ebbtide.operators.target import churn_as_of, churn_label, user_spans, with_last_activity


def with_country(spark, rows, country="nl"):
    users = spark.createDataFrame([(u, country) for u in {r[0] for r in rows}], "ID bigint, country string")
    return b.activity(spark, rows).join(users, "ID")


def test_week_includes_both_ends(spark):
    week = dt.date(2024, 5, 6)
    offsets = {-1: 0, 0: 1, 6: 1, 7: 0}
    for offset, expected in offsets.items():
        days = b.holidays(spark, [("nl", week + dt.timedelta(offset))])
        counted = add_holiday_counts(with_country(spark, [(1, week, 1)]), days)
        assert [r.holiday_count for r in counted.collect()] == [expected], offset


def test_null_start_is_kept_and_counts_nothing(spark):
    counted = add_holiday_counts(with_country(spark, [(1, None, 1)]), b.holidays(spark, [("nl", "2024-05-06")]))
    assert [(r.start_date_of_week, r.holiday_count) for r in counted.collect()] == [(None, 0)]


def test_same_week_twice_is_not_merged(spark):
    rows = [(1, "2024-05-06", 1), (1, "2024-05-06", 1)]
    counted = add_holiday_counts(with_country(spark, rows), b.holidays(spark, [("nl", "2024-05-07")] * 2))
    assert [r.holiday_count for r in counted.collect()] == [2, 2]


def test_counts_are_those_of_all_pairs_of_weeks_and_holidays(spark):
    draw = random.Random(3)
    first = dt.date(1969, 6, 1)  # before and after day 0
    listed = [(draw.choice(["nl", "be", "xx"]), first + dt.timedelta(draw.randrange(500))) for _ in range(90)]
    listed += [("nl", dt.date(2031, 1, 1))] * 5 + [("be", dt.date(1901, 2, 3))]
    weeks = [first + dt.timedelta(draw.randrange(-20, 520)) for _ in range(400)] + [dt.date(2030, 12, 29), dt.date(2050, 1, 1), dt.date(1800, 1, 1)]
    for country in ("nl", "be"):
        rows = with_country(spark, [(i, week, 1) for i, week in enumerate(weeks)], country)
        counted = add_holiday_counts(rows, b.holidays(spark, listed))
        want = [sum(c == country and 0 <= (day - week).days < 7 for c, day in listed) for week in weeks]
        assert [r.holiday_count for r in counted.orderBy("ID").collect()] == want
        plan = counted._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
        assert not any("start_date_of_week" in line.split("ENSURE")[0] for line in exchanges) and "BroadcastHashJoin" in plan


def test_unsupported_country_is_dropped_or_zero(spark):
    days = b.holidays(spark, [("nl", "2024-05-06")])
    for country in ("xx", None):
        rows = with_country(spark, [(1, "2024-05-06", 1)], country)
        assert add_holiday_counts(rows, days).count() == 0
        assert [r.holiday_count for r in add_holiday_counts(rows, days, "zero").collect()] == [0]


def test_holiday_dimension_skips_unknown_and_null_countries(spark):
    users = spark.createDataFrame([("nl",), ("nl",), ("xx",), (None,)], "country string")
    rules = spark.createDataFrame([("NL", 4, 27), ("BE", 7, 21)], "country_code string, month int, day int")
    found = {(r.country, str(r.holiday)) for r in holiday_dimension(users, rules, [2023, 2024]).collect()}
    assert found == {("nl", "2023-04-27"), ("nl", "2024-04-27")}


def test_label_is_strictly_beyond_the_limit(spark):
    newest = dt.date(2024, 12, 30)
    rows = [(1, newest, 1), (2, newest - dt.timedelta(365), 1), (3, newest - dt.timedelta(366), 1), (4, None, 1)]
    found = {r.ID: r.churned for r in churn_label(b.activity(spark, rows)).collect()}
    assert found == {1: False, 2: False, 3: True, 4: False}


def test_label_as_of_a_day(spark):
    found = churn_as_of(b.activity(spark, [(1, "2023-01-02", 1)]), "2024-01-02").first()
    assert found.churned is False
    assert churn_as_of(b.activity(spark, [(1, "2023-01-02", 1)]), "2024-01-03").first().churned is True


def test_rows_without_user_take_no_part(spark):
    rows = [(None, "2024-12-30", 1), (1, "2024-01-01", 1), (1, "2024-01-08", 1)]
    spans = user_spans(b.activity(spark, rows)).collect()
    assert [(r.ID, str(r.last_activity), r.user_rows) for r in spans] == [(1, "2024-01-08", 2)]
    assert with_last_activity(b.activity(spark, rows)).count() == 3
