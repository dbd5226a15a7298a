from __future__ import annotations

import datetime as dt
import random
import statistics

import builders as b
import pytest
from compare import differences

from ebbtide.operators.attributes import clean_attributes
from ebbtide.operators.features import Limits, feature_users, user_features
from ebbtide.operators.target import user_spans
from ebbtide.plans.feature_table import build_training_table, scoring_table, training_table
from ebbtide.schemas import HORIZONS, MEASURES, numeric_feature_names
from ebbtide.sources import retail_views as views

LAST = dt.date(2024, 12, 30)


def build(spark, rows, days=(("nl", "2024-12-25"),), countries=None, limits=Limits(), **options):
    frame = b.activity(spark, rows)
    people = b.attributes(spark, countries or {u: "NL" for u, *_ in rows if u is not None})
    return training_table(frame, people, b.holidays(spark, list(days)), limits=limits, **options)


def test_horizons_include_their_last_day(spark):
    offsets = [0, 30, 31, 90, 91, 180, 181, 365, 366]
    row = build(spark, [(1, LAST - dt.timedelta(d), 1) for d in offsets]).first()
    assert row.amount_views_sum == len(offsets)
    for days in HORIZONS:
        assert row[f"amount_views_sum_last_{days}_days"] == sum(d <= days for d in offsets)


def test_width_and_order_of_the_table(spark):
    table = build(spark, [(1, LAST, 1)])
    assert len(table.columns) == 188
    assert table.columns[0] == "ID" and table.columns[-1] == "churned"
    assert table.columns[1:182] == numeric_feature_names()


def test_values_of_one_user(spark):
    values = [4, 1, 7, 2]
    row = build(spark, [(1, LAST - dt.timedelta(7 * i), v) for i, v in enumerate(values)]).first()
    assert (row.num_of_active_weeks, row.days_subscribed) == (4, 21)
    for measure in MEASURES:
        assert row[f"{measure}_average"] == pytest.approx(3.5)
        assert (row[f"{measure}_min"], row[f"{measure}_max"], row[f"{measure}_sum"]) == (1, 7, 14)
        assert row[f"{measure}_median"] == statistics.median(values)
    assert row.num_of_holidays_in_the_last_30_days == 1


def test_all_null_measure_becomes_zero(spark):
    row = build(spark, [(1, LAST, None), (1, LAST - dt.timedelta(7), None)]).first()
    numbers = [row[n] for n in numeric_feature_names() if n.startswith("total_bidded")]
    assert numbers and not any(numbers)


def test_users_of_unsupported_countries(spark):
    rows = [(1, LAST, 1), (2, LAST, 1), (3, LAST, 1)]
    people = {1: "NL", 2: "XX"}
    assert {r.ID for r in build(spark, rows, countries=people).collect()} == {1}
    kept = {r.ID: r.country for r in build(spark, rows, countries=people, unsupported_country="zero").collect()}
    assert kept == {1: "nl", 2: "xx", 3: None}


def test_label_sees_users_without_features(spark):
    """The newest week belongs to a user without calendar; it still dates the label."""
    rows = [(1, LAST - dt.timedelta(400), 1), (2, LAST, 1)]
    assert [(r.ID, r.churned) for r in build(spark, rows, countries={1: "NL", 2: "XX"}).collect()] == [(1, True)]


def skewed_rows():
    """One user with a third of all rows, one with many, the others ordinary; values with ties."""
    draw = random.Random(7)
    rows = [(1, LAST - dt.timedelta(draw.randrange(0, 700)), draw.randrange(0, 50)) for _ in range(400)]
    rows += [(2, LAST - dt.timedelta(draw.randrange(0, 700)), draw.randrange(0, 9)) for _ in range(60)]
    rows += [(u, LAST - dt.timedelta(7 * w), draw.randrange(0, 99)) for u in range(3, 103) for w in range(8)]
    rows += [(1, None, 3), (2, LAST, None), (None, LAST, 5)]
    return rows


@pytest.mark.parametrize(
    "limits",
    [Limits(median_rows=50, hot_share=0.2), Limits(median_rows=50, hot_share=0.9), Limits(median_rows=5, hot_share=0.004)],
    ids=["hot-and-large", "large-only", "all-hot"],
)
def test_skewed_users_get_the_same_features(spark, limits):
    rows = skewed_rows()
    plain = build(spark, rows).toPandas()
    assert len(plain) == 102
    assert differences(build(spark, rows, limits=limits).toPandas(), plain) == []


def test_a_user_of_half_the_rows_is_dealt_over_tasks(spark, tmp_path):
    """One user has 30,000 of 60,000 rows and a task may hold 10,000 of a user."""
    everyone = "CASE WHEN id % 2 = 0 THEN 0 ELSE 1 + id % 997 END AS ID"
    value = "CASE WHEN id % 11 > 0 THEN (id * 7919) % 1013 END"
    frame = spark.range(0, 60_000, 1, 6).selectExpr(
        everyone, "CAST(NULL AS STRING) AS spare", f"date_sub(DATE'{LAST}', CAST((id * 31) % 500 AS INT)) AS start_date_of_week",
        *[f"CAST({value} AS {b.ACTIVITY_SCHEMA[m].dataType.simpleString()}) AS {m}" for m in MEASURES],
    )
    frame.write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    people = b.attributes(spark, {u: "NL" for u in range(1000)})
    days = b.holidays(spark, [("nl", "2024-12-25"), ("nl", "2024-10-03")])
    limits = Limits(median_rows=100, hot_share=1.0, task_rows=10_000)
    assert limits.hot_rows(60_000) == 10_000 and Limits().hot_rows(10**13) == 1_000_000
    split = training_table(stored, people, days, limits=limits)
    assert "_salt" in plan_of(split)
    plain = training_table(stored, people, days, limits=Limits(median_rows=10**6))
    assert plain.count() == 998
    assert differences(split.toPandas(), plain.toPandas()) == []


def test_hot_users_come_in_blocks_that_can_be_broadcast(spark, monkeypatch):
    from ebbtide.operators import features

    monkeypatch.setattr(features, "BROADCAST_ROWS", 20)
    rows = skewed_rows()
    limits = Limits(median_rows=5, hot_share=1.0, task_rows=6)
    assert differences(build(spark, rows, limits=limits).toPandas(), build(spark, rows).toPandas()) == []


def test_scoring_rows_equal_training_rows(spark, small):
    inputs = [f(spark, small) for f in (views.activity, views.attributes, views.holidays)]
    trained = training_table(*inputs).drop("churned")
    wanted = [r.ID for r in trained.select("ID").limit(5).collect()]
    asked = scoring_table(*inputs, users=wanted)
    table = scoring_table(*inputs, users=spark.createDataFrame([(u,) for u in wanted], "ID bigint"))
    expected = trained.where(trained.ID.isin(wanted)).toPandas()
    assert differences(asked.toPandas(), expected) == []
    assert differences(table.toPandas(), expected) == []


def test_horizon_sums_grow_and_medians_lie_inside(spark, small):
    inputs = [f(spark, small) for f in (views.activity, views.attributes, views.holidays)]
    frame = training_table(*inputs).toPandas()
    for m in MEASURES:
        sums = [frame[f"{m}_sum_last_{d}_days"] for d in HORIZONS] + [frame[f"{m}_sum"]]
        assert all((a <= c + 1e-6).all() for a, c in zip(sums, sums[1:]))
        assert (frame[f"{m}_min"] <= frame[f"{m}_median"]).all()
        assert (frame[f"{m}_median"] <= frame[f"{m}_max"]).all()


def test_written_table_is_reused_only_when_asked(spark, tmp_path):
    path = str(tmp_path / "features")
    args = (b.attributes(spark, {1: "NL", 2: "NL"}), b.holidays(spark, [("nl", "2024-12-25")]))
    build_training_table(b.activity(spark, [(1, LAST, 1)]), *args, path)
    both = b.activity(spark, [(1, LAST, 1), (2, LAST, 1)])
    assert build_training_table(both, *args, path, reuse=True).count() == 1
    assert build_training_table(both, *args, path).count() == 2


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_activity_is_shuffled_once_and_only_by_user(spark, tmp_path):
    """The scan reads the needed columns, and one exchange serves join and all aggregates."""
    b.activity(spark, [(u, LAST, 1) for u in range(50)]).write.parquet(str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a"))
    people = clean_attributes(b.attributes(spark, {u: "NL" for u in range(50)}))
    days = b.holidays(spark, [("nl", "2024-12-25")])
    users = feature_users(user_spans(stored), people, days)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(user_features(stored, users, days))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    measured = [line for line in plan.splitlines() if "FileScan" in line and "money_spend" in line]
    assert len(measured) == 1 and "platform" not in measured[0].split("ReadSchema")[1]
    spine = plan[: plan.index(measured[0])]
    assert spine.count("Exchange hashpartitioning(ID") == 1
    assert "Exchange hashpartitioning(ID" in spine and "Exchange hashpartitioning(country" not in spine


def test_user_filter_reaches_the_scan(spark, tmp_path):
    from ebbtide.sources.readers import for_users, read_activity

    b.activity(spark, [(u, LAST, 1) for u in range(50)]).write.parquet(str(tmp_path / "a"))
    plan = plan_of(for_users(read_activity(spark, str(tmp_path / "a"), "parquet"), 7))
    assert "EqualTo(ID,7)" in plan.split("PushedFilters")[1]


def test_statistics_of_each_horizon_without_copies(spark):
    """Against Spark's own aggregates, with users that reach over the batches of a task, nulls and NaN."""
    from pyspark.sql import functions as F

    from ebbtide.operators.user_statistics import statistics_by_user

    draw = random.Random(5)
    rows = []
    for user, n in enumerate([1, 2, 3, 40, 1, 7, 300]):
        for _ in range(n):
            start = draw.choice([None, LAST - dt.timedelta(draw.randint(0, 100))])
            whole = draw.choice([None, draw.randint(-5, 5)])
            rows.append((user, [None, "a"][user % 2], start, LAST, 1, whole, draw.choice([None, float("nan"), draw.random(), -1.0])))
    frame = spark.createDataFrame(rows, "ID long, c string, s date, l date, h long, i int, d double").repartition(3)
    found = statistics_by_user(frame, ["ID", "c"], ["i", "d"], "s", "l", "h", F.col("ID") != 3, [30, 90], task_rows=5)
    assert "Generate" not in plan_of(found) and "ObjectHash" not in plan_of(found)
    wanted = []
    for days in (0, 30, 90):
        rule = "true" if not days else f"datediff(l, s) <= {days}"
        wanted += [f"sum(h) FILTER (WHERE {rule}) AS d{days}_holidays"] if days else [
            "count(s) AS d0_num_of_active_weeks", "datediff(max(s), min(s)) AS d0_days_subscribed"]
        for name in ("i", "d"):
            for statistic in ("avg", "min", "max", "median", "sum"):
                kept = f"{statistic}({name}) FILTER (WHERE {rule})"
                kept = f"if(ID <> 3, {kept}, null)" if statistic == "median" else kept
                wanted.append(f"{kept} AS d{days}_{name}_{statistic.replace('avg', 'average')}")
    plain = frame.groupBy("ID", "c").agg(*map(F.expr, wanted))
    assert dict(found.dtypes) == dict(plain.dtypes)
    for one, two in zip(found.orderBy("ID").collect(), plain.select(*found.columns).orderBy("ID").collect(), strict=True):
        for name, x, y in zip(found.columns, one, two):
            same = x == y or (x != x and y != y) or (isinstance(x, float) and x == pytest.approx(y))
            assert same, (one.ID, name, x, y)


def test_ordered_tables_compute_their_rows_once(spark, tmp_path):
    from ebbtide.sources.readers import write_table

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = write_table(spark.range(500).mapInArrow(counted, "id long"), str(tmp_path / "t"), order_by="id")
    assert found.count() == 500 and seen.value == 500
