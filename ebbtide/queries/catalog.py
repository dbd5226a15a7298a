"""Every operator as a query over the retail tables, with its DuckDB counterpart where SQL has one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import columns as cols
from ebbtide.operators import attribution, correlation, encoders, metrics, splits, target
from ebbtide.operators.attributes import clean_attributes
from ebbtide.operators.features import feature_users, user_features
from ebbtide.operators.holidays import add_holiday_counts, holidays_by_week_start
from ebbtide.plans.feature_table import build_training_table, scoring_table, training_table
from ebbtide.plans.scoring import decide, with_message
from ebbtide.plans.training import LEAST_IMPORTANCE, weak_columns
from ebbtide.queries import views_sql as sql
from ebbtide.schemas import (
    ATTRIBUTES,
    CHURNED,
    COUNTRY,
    HORIZONS,
    ID,
    MEASURES,
    START,
    lifetime_feature_names,
    numeric_feature_names,
)
from ebbtide.session import stage, work_folder
from ebbtide.sources import retail_views as views
from ebbtide.sources.readers import for_users, read_activity, read_attributes, read_holidays, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return add


def rounded(df: DataFrame, names: list[str], digits: int = sql.DIGITS) -> DataFrame:
    wanted = set(names)
    return df.selectExpr(
        *[f"round(CAST(`{n}` AS DOUBLE), {digits}) AS `{n}`" if n in wanted else f"`{n}`" for n in df.columns]
    )


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_attributes(views.attributes(spark, sf_dir))


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Activity is written first, as the jobs read it more than once."""
    return (
        stage(views.activity(spark, sf_dir), "activity"),
        views.attributes(spark, sf_dir),
        views.holidays(spark, sf_dir),
    )


# ---- reading, attributes, holidays ----------------------------------------------------------------


@register("activity_scan", f"WITH {sql.ACTIVITY} SELECT * FROM activity")
def activity_scan(spark, sf_dir):
    return views.activity(spark, sf_dir)


URGENT = "SELECT DISTINCT o_custkey AS ID FROM orders WHERE o_orderpriority = '1-URGENT'"


def urgent_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A requested set of users: those with an urgent order."""
    orders = views.table(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias(ID)).distinct()


@register(
    "activity_of_requested_users",
    f"WITH {sql.ACTIVITY} SELECT * FROM activity WHERE ID IN ({URGENT})",
)
def activity_of_requested_users(spark, sf_dir):
    return for_users(views.activity(spark, sf_dir), urgent_users(spark, sf_dir))


@register("attributes_clean", f"WITH {sql.ATTRIBUTES} SELECT * FROM attributes")
def attributes_clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register(
    "attributes_of_requested_users",
    f"WITH {sql.ATTRIBUTES} SELECT * FROM attributes WHERE ID IN ({URGENT})",
)
def attributes_of_requested_users(spark, sf_dir):
    return for_users(cleaned(spark, sf_dir), urgent_users(spark, sf_dir))


@register("holiday_dimension", f"WITH {sql.HOLIDAYS} SELECT DISTINCT country, holiday FROM holidays")
def holiday_dimension(spark, sf_dir):
    return views.holidays(spark, sf_dir)


@register(
    "holidays_by_week_start",
    f"WITH {sql.HOLIDAYS} SELECT country, holiday - CAST(k AS INT) AS start_date_of_week, count(*) AS holiday_count "
    "FROM holidays, range(7) AS r(k) GROUP BY country, holiday - CAST(k AS INT)",
)
def week_starts(spark, sf_dir):
    return holidays_by_week_start(views.holidays(spark, sf_dir))


def _with_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.activity(spark, sf_dir).join(cleaned(spark, sf_dir).select(ID, COUNTRY), ID, "left")


@register(
    "holiday_counts",
    f"{sql.INPUTS} SELECT ID, start_date_of_week, country, holiday_count FROM counted",
)
def holiday_counts(spark, sf_dir):
    counted = add_holiday_counts(_with_country(spark, sf_dir), views.holidays(spark, sf_dir))
    return counted.select(ID, START, COUNTRY, "holiday_count")


@register(
    "holiday_counts_all_countries",
    f"{sql.INPUTS} SELECT n.ID, n.start_date_of_week, n.country, CAST(coalesce(f.holiday_count, 0) AS BIGINT) AS "
    "holiday_count FROM numbered n LEFT JOIN flagged f ON n.idx = f.idx",
)
def holiday_counts_all_countries(spark, sf_dir):
    counted = add_holiday_counts(_with_country(spark, sf_dir), views.holidays(spark, sf_dir), "zero")
    return counted.select(ID, START, COUNTRY, "holiday_count")


# ---- label ------------------------------------------------------------------------------------------


@register("churn_label", f"WITH {sql.ACTIVITY}, {sql.LABEL} SELECT ID, churned FROM label")
def churn_label(spark, sf_dir):
    return target.churn_label(views.activity(spark, sf_dir))


@register(
    "churn_as_of",
    f"WITH {sql.ACTIVITY}, {sql.LABEL} SELECT ID, CASE WHEN date_diff('day', last_activity, DATE '2001-12-31') > 365 "
    "THEN TRUE ELSE FALSE END AS churned FROM last_weeks",
)
def churn_as_of(spark, sf_dir):
    return target.churn_as_of(views.activity(spark, sf_dir), "2001-12-31")


@register(
    "last_activity_per_row",
    f"WITH {sql.ACTIVITY}, {sql.LABEL} SELECT ID, start_date_of_week, last_activity FROM activity LEFT JOIN last_weeks "
    "USING (ID)",
)
def last_activity_per_row(spark, sf_dir):
    return target.with_last_activity(views.activity(spark, sf_dir)).select(ID, START, "last_activity")


EVENT_ACTIVITY = """
WITH activity AS (
  SELECT user_id AS ID, CAST(date_trunc('week', ts) AS DATE) AS start_date_of_week, CAST(count(*) AS INT) AS amount_views,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INT) AS bids_places,
         round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS money_spend
  FROM events GROUP BY user_id, date_trunc('week', ts)),
last_weeks AS (SELECT ID, max(start_date_of_week) AS last_activity FROM activity GROUP BY ID)"""


@register(
    "event_churn_14_days",
    EVENT_ACTIVITY + " SELECT ID, CASE WHEN date_diff('day', last_activity, (SELECT max(last_activity) FROM "
    "last_weeks)) > 14 THEN TRUE ELSE FALSE END AS churned FROM last_weeks",
)
def event_churn(spark, sf_dir):
    return target.churn_label(views.event_activity(spark, sf_dir), after_days=14)


# ---- features ---------------------------------------------------------------------------------------


def _features(spark: SparkSession, sf_dir: str, horizons: list[int]) -> DataFrame:
    activity, attributes, holidays = inputs(spark, sf_dir)
    spans = stage(target.user_spans(activity), "spans")
    users = feature_users(spans, clean_attributes(attributes), holidays)
    return user_features(activity, users, holidays, horizons=horizons)


LIFETIME_NAMES = ["num_of_active_weeks", "days_subscribed", *lifetime_feature_names()]


@register(
    "lifetime_features",
    f"{sql.INPUTS}, lifetime AS ({sql.lifetime('counted')}) SELECT ID, "
    f"{', '.join(map(sql.rounded, LIFETIME_NAMES))} FROM lifetime",
)
def lifetime_features(spark, sf_dir):
    return rounded(_features(spark, sf_dir, []), LIFETIME_NAMES)


ALL_NAMES = numeric_feature_names()


@register(
    "horizon_features",
    f"{sql.INPUTS}, {sql.feature_ctes()} SELECT ID, "
    f"{', '.join(sql.rounded(n) for n in ALL_NAMES if n not in LIFETIME_NAMES)} FROM features",
)
def horizon_features(spark, sf_dir):
    names = [n for n in ALL_NAMES if n not in LIFETIME_NAMES]
    return rounded(_features(spark, sf_dir, HORIZONS), names).select(ID, *names)


SHORT_HORIZONS = [7, 14, 21]
EVENT_NAMES = [
    n for n in numeric_feature_names(SHORT_HORIZONS) if n.startswith(("amount_views", "bids_places", "money_spend"))
]


def _event_sql() -> str:
    measured = ["amount_views", "bids_places", "money_spend"]

    def stats(days: int | None) -> str:
        return ", ".join(s for s in sql.statistics(days) if any(f"({m})" in s for m in measured))

    parts = [
        EVENT_ACTIVITY,
        "dated AS (SELECT activity.*, last_activity FROM activity LEFT JOIN last_weeks USING (ID))",
        f"life AS (SELECT ID, {stats(None)} FROM activity GROUP BY ID)",
    ]
    parts += [
        f"h{d} AS (SELECT ID, {stats(d)} FROM dated WHERE date_diff('day', start_date_of_week, last_activity) <= {d} "
        "GROUP BY ID)"
        for d in SHORT_HORIZONS
    ]
    joins = " ".join(f"LEFT JOIN h{d} USING (ID)" for d in SHORT_HORIZONS)
    return f"{', '.join(parts)} SELECT ID, {', '.join(map(sql.rounded, EVENT_NAMES))} FROM life {joins}"


@register("event_features_short_horizons", _event_sql())
def event_features(spark, sf_dir):
    activity = stage(views.event_activity(spark, sf_dir), "events")
    attributes = clean_attributes(views.attributes(spark, sf_dir))
    holidays = views.holidays(spark, sf_dir)
    users = feature_users(stage(target.user_spans(activity), "spans"), attributes, holidays, "zero")
    features = user_features(activity, users, holidays, horizons=SHORT_HORIZONS)
    return rounded(features, EVENT_NAMES).select(ID, *EVENT_NAMES)


TRAINING_SQL = (
    f"{sql.INPUTS}, {sql.LABEL}, {sql.feature_ctes()} SELECT ID, {', '.join(map(sql.rounded, ALL_NAMES))}, "
    f"{', '.join(ATTRIBUTES)}, churned FROM features LEFT JOIN attributes USING (ID) JOIN label USING (ID)"
)


@register("feature_table", TRAINING_SQL)
def feature_table(spark, sf_dir):
    return rounded(training_table(*inputs(spark, sf_dir)), ALL_NAMES)


@register("feature_table_written", TRAINING_SQL)
def feature_table_written(spark, sf_dir):
    """The whole job: inputs from files, features to a file and back."""
    folder = f"{work_folder(spark)}/files-{uuid.uuid4().hex}"
    activity, people, days = inputs(spark, sf_dir)
    people.write.option("header", True).csv(f"{folder}/attributes")
    write_table(days, f"{folder}/holidays")
    read = read_attributes(spark, f"{folder}/attributes"), read_holidays(spark, f"{folder}/holidays")
    return rounded(build_training_table(activity, *read, f"{folder}/features"), ALL_NAMES)


@register("activity_read_from_files", f"WITH {sql.ACTIVITY} SELECT * FROM activity")
def activity_read_from_files(spark, sf_dir):
    path = f"{work_folder(spark)}/files-{uuid.uuid4().hex}/activity"
    views.activity(spark, sf_dir).write.option("header", True).csv(path)
    return read_activity(spark, path)


@register("attributes_read_from_files", f"WITH {sql.ATTRIBUTES} SELECT * FROM attributes")
def attributes_read_from_files(spark, sf_dir):
    path = f"{work_folder(spark)}/files-{uuid.uuid4().hex}/attributes"
    views.attributes(spark, sf_dir).write.option("header", True).csv(path)
    return clean_attributes(read_attributes(spark, path))


@register("holidays_written_and_read", f"WITH {sql.HOLIDAYS} SELECT DISTINCT country, holiday FROM holidays")
def holidays_written_and_read(spark, sf_dir):
    path = f"{work_folder(spark)}/files-{uuid.uuid4().hex}/holidays"
    write_table(views.holidays(spark, sf_dir), path, order_by="country")
    return read_holidays(spark, path)


@register(
    "feature_table_all_countries",
    f"{sql.INPUTS}, {sql.LABEL}, "
    + sql.feature_ctes().replace("counted", "kept").join(
        ["kept AS (SELECT n.*, CAST(coalesce(f.holiday_count, 0) AS BIGINT) AS holiday_count FROM numbered n LEFT JOIN "
         "flagged f ON n.idx = f.idx), ", ""]
    )
    + f" SELECT ID, {', '.join(map(sql.rounded, ALL_NAMES))}, {', '.join(ATTRIBUTES)}, churned "
    "FROM features LEFT JOIN attributes USING (ID) JOIN label USING (ID)",
)
def feature_table_all_countries(spark, sf_dir):
    return rounded(training_table(*inputs(spark, sf_dir), unsupported_country="zero"), ALL_NAMES)


@register(
    "scoring_features",
    f"{sql.INPUTS}, {sql.feature_ctes()} SELECT ID, {', '.join(map(sql.rounded, ALL_NAMES))}, "
    f"{', '.join(ATTRIBUTES)} FROM features LEFT JOIN attributes USING (ID) WHERE ID IN ({URGENT})",
)
def scoring_features(spark, sf_dir):
    wanted = urgent_users(spark, sf_dir)
    return rounded(scoring_table(*inputs(spark, sf_dir), users=wanted), ALL_NAMES)


FLOAT_NAMES = [n for n in lifetime_feature_names() if n.endswith(("_average", "_median"))]


@register(
    "features_single_precision",
    f"{sql.INPUTS}, lifetime AS ({sql.lifetime('counted')}) SELECT ID, "
    + ", ".join(f"round(CAST(CAST({n} AS FLOAT) AS DOUBLE), 2) AS {n}" for n in FLOAT_NAMES)
    + " FROM lifetime",
)
def features_single_precision(spark, sf_dir):
    narrow = cols.doubles_to_floats(_features(spark, sf_dir, []).select(ID, *FLOAT_NAMES))
    return rounded(narrow, FLOAT_NAMES, 2)


AVERAGES = [n for n in lifetime_feature_names() if n.endswith("_average")]


@register(
    "features_averages_only",
    f"{sql.INPUTS}, lifetime AS ({sql.lifetime('counted')}) SELECT ID, num_of_active_weeks, days_subscribed AS "
    f"tenure, {', '.join(map(sql.rounded, AVERAGES))} FROM lifetime",
)
def features_averages_only(spark, sf_dir):
    reduced = cols.drop_by_suffix(
        _features(spark, sf_dir, []).withColumn("tenure", F.col("days_subscribed").cast("long")),
        ("min", "max", "median", "sum", "days_subscribed"),
    )
    return rounded(reduced, AVERAGES)


# ---- splits and weights -----------------------------------------------------------------------------


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(target.churn_label(views.activity(spark, sf_dir)), "labels")


LABELS = f"WITH {sql.ACTIVITY}, {sql.LABEL}"


@register(
    "balanced_weights",
    f"{LABELS} SELECT ID, churned, round(CAST(count(*) OVER () AS DOUBLE) / ((SELECT count(DISTINCT churned) FROM label) "
    "* count(*) OVER (PARTITION BY churned)), 9) AS weight FROM label",
)
def balanced_weights(spark, sf_dir):
    return rounded(splits.with_balanced_weights(labels(spark, sf_dir), CHURNED), ["weight"], 9)


# Rows of each class drawn for the training part: whole parts, then the largest fractions.
SHARES = """
ordered AS (SELECT ID, churned, row_number() OVER (PARTITION BY churned ORDER BY md5(concat('42:', ID)), ID) AS place
            FROM label),
sizes AS (SELECT churned, count(*) AS c, (SELECT count(*) FROM label) AS n FROM label GROUP BY churned)"""


def _share(source: str, rows: str, wanted: str, name: str) -> str:
    return (
        f"{name} AS (SELECT *, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, churned) "
        f"<= {wanted} - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS {name}_rows FROM (SELECT *, CAST({rows} AS DOUBLE) * "
        f"{wanted} / sum({rows}) OVER () AS x FROM {source}))"
    )


TENTH = "CAST(0.1 AS DOUBLE)"
SPLIT = (
    f"{LABELS}, {SHARES}, "
    + _share("sizes", "c", "(n - ceil(n * CAST(0.2 AS DOUBLE)))", "first")
    + ", parted AS (SELECT ID, churned, CASE WHEN place <= first_rows THEN 'train' ELSE 'test' END AS split "
    "FROM ordered JOIN first USING (churned))"
)


@register("stratified_split", f"{SPLIT} SELECT ID, churned, split FROM parted")
def stratified_split(spark, sf_dir):
    return splits.stratified_split(labels(spark, sf_dir), CHURNED, ID)


@register(
    "three_way_split",
    f"{LABELS}, {SHARES}, "
    + _share("sizes", "c", f"(n - ceil(n * {TENTH}))", "kept")
    + ", "
    + _share("(SELECT churned, kept_rows, n FROM kept)", "kept_rows", f"(n - ceil(n * {TENTH}) - ceil(n * {TENTH}))", "first")
    + " SELECT ID, churned, CASE WHEN place <= first_rows THEN 'train' WHEN place <= kept_rows THEN 'test' "
    "ELSE 'valid' END AS split FROM ordered JOIN first USING (churned)",
)
def three_way_split(spark, sf_dir):
    return splits.three_way_split(labels(spark, sf_dir), CHURNED, ID)


# Deal the rows, sorted by class, out to five folds in turn; then fill the folds block by block.
FOLDS = f"""{LABELS},
classes AS (SELECT churned, row_number() OVER (ORDER BY min(ID)) AS class_no FROM label GROUP BY churned),
dealt AS (SELECT churned, (row_number() OVER (ORDER BY class_no, ID) - 1) % 5 AS fold FROM label JOIN classes USING (churned)),
blocks AS (SELECT churned, fold, sum(count(*)) OVER (PARTITION BY churned ORDER BY fold) AS upto FROM dealt GROUP BY churned, fold),
placed AS (SELECT ID, churned, row_number() OVER (PARTITION BY churned ORDER BY ID) AS place FROM label),
folded AS (SELECT p.ID, p.churned, CAST(min(b.fold) AS INT) AS fold FROM placed p JOIN blocks b
           ON p.churned = b.churned AND p.place <= b.upto GROUP BY p.ID, p.churned)"""


@register("stratified_folds", f"{FOLDS} SELECT ID, churned, fold FROM folded")
def stratified_folds(spark, sf_dir):
    return splits.stratified_folds(labels(spark, sf_dir), CHURNED, ID)


# ---- encoders and scalers ---------------------------------------------------------------------------


@register(
    "category_counts",
    f"WITH {sql.ATTRIBUTES} SELECT 'mobile_device' AS \"column\", count(DISTINCT mobile_device) AS categories FROM "
    "attributes UNION ALL SELECT 'country', count(DISTINCT country) FROM attributes UNION ALL SELECT "
    "'preferred_language', count(DISTINCT preferred_language) FROM attributes UNION ALL SELECT 'gender', "
    "count(DISTINCT gender) FROM attributes",
)
def category_counts(spark, sf_dir):
    return encoders.category_counts(cleaned(spark, sf_dir))


@register(
    "column_routing",
    f"WITH {sql.ATTRIBUTES}, counts AS (SELECT count(DISTINCT mobile_device) AS mobile_device, count(DISTINCT country) "
    "AS country, count(DISTINCT preferred_language) AS preferred_language, count(DISTINCT gender) AS gender FROM "
    "attributes) SELECT \"column\", CASE WHEN n <= 5 THEN 'one_hot' ELSE 'ordinal' END AS encoding FROM counts "
    "UNPIVOT (n FOR \"column\" IN (mobile_device, country, preferred_language, gender))",
)
def column_routing(spark, sf_dir):
    few = F.col("categories") <= encoders.ONE_HOT_CATEGORIES
    return encoders.category_counts(cleaned(spark, sf_dir)).select(
        "column", F.when(few, "one_hot").otherwise("ordinal").alias("encoding")
    )


ONE_HOT = {
    "gender": ["m"],
    "mobile_device": ["ipad", "iphone", "unknown"],
    "preferred_language": ["en", "fr", "it", "nl"],
}
ONE_HOT_SQL = ", ".join(
    f"CAST({c} = '{v}' AS DOUBLE) AS {c}_{v}" for c, values in ONE_HOT.items() for v in values
)


@register("one_hot_encoding", f"WITH {sql.ATTRIBUTES} SELECT ID, {ONE_HOT_SQL} FROM attributes")
def one_hot_encoding(spark, sf_dir):
    attributes = cleaned(spark, sf_dir)
    one_hot, _ = encoders.route_columns(attributes)
    made = encoders.one_hot_columns(encoders.one_hot_labels(attributes, one_hot))
    return attributes.select(ID, *[c.cast("double").alias(n) for n, c in made.items()])


COUNTRY_CODES = "codes AS (SELECT country, dense_rank() OVER (ORDER BY country) - 1 AS code FROM attributes GROUP BY country)"


@register(
    "ordinal_encoding",
    f"WITH {sql.ATTRIBUTES}, {COUNTRY_CODES} SELECT ID, CAST(code AS DOUBLE) AS country FROM attributes JOIN codes "
    "USING (country)",
)
def ordinal_encoding(spark, sf_dir):
    attributes = cleaned(spark, sf_dir)
    table = stage(encoders.ordinal_labels(attributes, COUNTRY), "labels")
    coded = encoders.ordinal_encode(attributes.select(ID, COUNTRY), COUNTRY, table)
    return coded.withColumn(COUNTRY, F.col(COUNTRY).cast("double"))


@register(
    "ordinal_encoding_unseen",
    f"WITH {sql.ATTRIBUTES}, known AS (SELECT DISTINCT country FROM attributes WHERE is_company AND preferred_language "
    "<> 'en'), codes AS (SELECT country, row_number() OVER (ORDER BY country) - 1 AS code FROM known) SELECT ID, "
    "CAST(coalesce(code, -1) AS DOUBLE) AS country FROM attributes LEFT JOIN codes USING (country)",
)
def ordinal_encoding_unseen(spark, sf_dir):
    """Fitted on the companies that do not speak English, so that their countries are all it knows."""
    attributes = cleaned(spark, sf_dir)
    known = attributes.where(F.col("is_company") & (F.col("preferred_language") != "en"))
    table = stage(encoders.ordinal_labels(known, COUNTRY), "labels")
    coded = encoders.ordinal_encode(attributes.select(ID, COUNTRY), COUNTRY, table)
    return coded.withColumn(COUNTRY, F.col(COUNTRY).cast("double"))


def _scaled(spark: SparkSession, sf_dir: str, fit) -> DataFrame:
    activity = stage(views.activity(spark, sf_dir), "activity")
    fitted = fit(activity, MEASURES)
    made = [F.round(encoders.scaled(c, *fitted[c]), sql.DIGITS).alias(c) for c in MEASURES]
    return activity.select(ID, START, *made)


@register(
    "standard_scaling",
    f"WITH {sql.ACTIVITY} SELECT ID, start_date_of_week, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}" for c in MEASURES
    )
    + " FROM activity",
)
def standard_scaling(spark, sf_dir):
    return _scaled(spark, sf_dir, encoders.standard_scale)


def _quantile(column: str, p: float) -> str:
    return f"quantile_cont(CAST({column} AS DOUBLE), {p})"


QUARTILES = ", ".join(
    f"{_quantile(c, p)} AS {c}_{i}" for c in MEASURES for i, p in enumerate([0.25, 0.5, 0.75])
)


@register(
    "robust_scaling",
    f"WITH {sql.ACTIVITY}, q AS (SELECT {QUARTILES} FROM activity) SELECT ID, start_date_of_week, "
    + ", ".join(
        f"round(({c} - {c}_1) / CASE WHEN {c}_2 = {c}_0 THEN 1 ELSE {c}_2 - {c}_0 END, 6) AS {c}" for c in MEASURES
    )
    + " FROM activity, q",
)
def robust_scaling(spark, sf_dir):
    return _scaled(spark, sf_dir, encoders.robust_scale)


@register(
    "column_quartiles",
    f"WITH {sql.ACTIVITY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {', '.join(f'round({_quantile(c, p)}, 6) AS {n}' for n, p in [('q1', 0.25), ('median', 0.5), ('q3', 0.75)])} "
        "FROM activity"
        for c in MEASURES
    ),
)
def column_quartiles(spark, sf_dir):
    activity = stage(views.activity(spark, sf_dir), "activity")
    found = encoders.column_quartiles(activity, MEASURES)
    names = ["q1", "median", "q3"]
    return found.select("column", *[F.round(F.col("quantiles")[i], 6).alias(n) for i, n in enumerate(names)])


@register(
    "column_encoder",
    f"WITH {sql.ACTIVITY}, {sql.ATTRIBUTES}, {COUNTRY_CODES}, weeks AS (SELECT ID, count(*) AS weeks FROM activity GROUP BY "
    f"ID), both_ AS (SELECT * FROM attributes JOIN weeks USING (ID)), q AS (SELECT {_quantile('weeks', 0.25)} AS a, "
    f"{_quantile('weeks', 0.5)} AS b, {_quantile('weeks', 0.75)} AS c FROM both_) SELECT ID, {ONE_HOT_SQL}, "
    "CAST(code AS DOUBLE) AS country, round((weeks - b) / CASE WHEN a = c THEN 1 ELSE c - a END, 6) AS weeks, is_company "
    "FROM both_ JOIN codes USING (country), q",
)
def column_encoder(spark, sf_dir):
    weeks = views.activity(spark, sf_dir).groupBy(ID).agg(F.count(F.lit(1)).alias("weeks"))
    rows = stage(cleaned(spark, sf_dir).join(weeks, ID), "rows")
    encoded = encoders.ColumnEncoder(excluded=[ID]).fit(rows).transform(rows)
    return rounded(encoded, [n for n in encoded.columns if n not in (ID, "is_company")])


# ---- correlations -----------------------------------------------------------------------------------

CORRELATED = ["num_of_active_weeks", *AVERAGES]


def _corr(a: str, b: str) -> str:
    return f"round(CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END, 6)"


@register(
    "correlation_pairs",
    f"{sql.INPUTS}, lifetime AS ({sql.lifetime('counted')}) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS feature, '{b}' AS other, {_corr(a, b)} AS correlation FROM lifetime"
        for i, a in enumerate(CORRELATED)
        for b in CORRELATED[:i]
    ),
)
def correlation_pairs(spark, sf_dir):
    features = stage(_features(spark, sf_dir, []), "features")
    return rounded(correlation.correlation_pairs(features, CORRELATED), ["correlation"])


@register(
    "correlation_with_churn",
    f"{sql.INPUTS}, {sql.LABEL}, {sql.feature_ctes()}, rows_ AS (SELECT churned, "
    + ", ".join(f"CAST(coalesce({n}, 0) AS DOUBLE) AS {n}" for n in ALL_NAMES)
    + " FROM features JOIN label USING (ID)), found AS (SELECT "
    + ", ".join(f"{_corr(n, 'CAST(churned AS DOUBLE)')} AS {n}" for n in ALL_NAMES)
    + f" FROM rows_) SELECT feature, correlation FROM found UNPIVOT INCLUDE NULLS (correlation FOR feature IN ({', '.join(ALL_NAMES)}))",
)
def correlation_with_churn(spark, sf_dir):
    table = stage(training_table(*inputs(spark, sf_dir)), "features")
    found = correlation.correlation_with_target(table, ALL_NAMES, CHURNED)
    return correlation.ranked_by_correlation(rounded(found, ["correlation"]))


# ---- evaluation -------------------------------------------------------------------------------------
# A score without a model: the less money was bid over all weeks, the likelier churn. It takes a
# different value for nearly every user; ``coarse`` depends on the number of weeks only and has many ties.

SCORED = f"""{FOLDS},
money AS (SELECT ID, count(*) AS weeks, sum(total_bidded) AS bid FROM activity GROUP BY ID),
scored AS (SELECT ID, churned, fold, round(1 / (1 + bid / 500000.0), 9) AS p, round(1 / (1 + weeks / CAST(5 AS DOUBLE)), 9) AS coarse,
                  CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY churned)) AS w,
                  CAST(count(*) OVER (PARTITION BY fold) AS DOUBLE) / (2 * count(*) OVER (PARTITION BY fold, churned)) AS fw
           FROM folded JOIN money USING (ID))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    activity = stage(views.activity(spark, sf_dir), "activity")
    money = activity.groupBy(ID).agg(F.count(F.lit(1)).alias("weeks"), F.sum("total_bidded").alias("bid"))
    rows = target.churn_label(activity).join(money, ID).select(
        ID,
        CHURNED,
        F.round(1 / (1 + F.col("bid") / 500000.0), 9).alias("p"),
        F.round(1 / (1 + F.col("weeks") / 5.0), 9).alias("coarse"),
    )
    return stage(splits.with_balanced_weights(rows, CHURNED, weight="w"), "scored")


def scored_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = splits.stratified_folds(scored(spark, sf_dir), CHURNED, ID)
    return stage(splits.with_balanced_weights(folded, CHURNED, ["fold"], "fw"), "scored")


CELLS = ["tn", "fp", "fn", "tp"]


def _cells(weight: str, score: str = "p", threshold: str = "CAST(0.5 AS DOUBLE)") -> str:
    tests = [("NOT churned", "<="), ("NOT churned", ">"), ("churned", "<="), ("churned", ">")]
    return ", ".join(
        f"sum(CASE WHEN {y} AND {score} {op} {threshold} THEN {weight} ELSE 0 END) AS {c}"
        for c, (y, op) in zip(CELLS, tests)
    )


def _decided(rows: DataFrame, score: str = "p") -> DataFrame:
    return rows.withColumn("predicted", F.col(score) > 0.5)


@register(
    "confusion_matrix",
    f"{SCORED}, m AS (SELECT {_cells('w')} FROM scored) SELECT {', '.join(f'round({c}, 6) AS {c}' for c in CELLS)} FROM m",
)
def confusion_matrix(spark, sf_dir):
    return rounded(metrics.confusion(_decided(scored(spark, sf_dir)), CHURNED, "predicted", "w"), CELLS)


@register(
    "confusion_matrix_normalised",
    f"{SCORED}, m AS (SELECT {_cells('w')} FROM scored) SELECT "
    + ", ".join(f"round({c} / (tn + fp + fn + tp), 6) AS {c}" for c in CELLS)
    + " FROM m",
)
def confusion_matrix_normalised(spark, sf_dir):
    matrix = metrics.confusion(_decided(scored(spark, sf_dir)), CHURNED, "predicted", "w")
    return rounded(metrics.normalised_confusion(matrix), CELLS)


def _steps(score: str, weight: str, by: str = "") -> str:
    """Cumulative weights from high to low scores, over everything or per ``by``."""
    group, window = (f"{by}, ", f"PARTITION BY {by} ") if by else ("", "")
    return (
        f"raw_steps AS (SELECT {group}{score} AS s, sum(CASE WHEN churned THEN {weight} ELSE 0 END) AS dtp, "
        f"sum(CASE WHEN churned THEN 0 ELSE {weight} END) AS dfp FROM scored GROUP BY {group}{score}), "
        f"steps AS (SELECT *, sum(dtp) OVER ({window}ORDER BY s DESC) AS tp, sum(dfp) OVER ({window}ORDER BY s DESC) AS fp, "
        f"sum(dtp) OVER ({window}) AS p_all, sum(dfp) OVER ({window}) AS n_all FROM raw_steps)"
    )


def _curve(name: str, score: str) -> None:
    @register(
        f"roc_curve_{name}",
        f"{SCORED}, {_steps(score, 'w')} SELECT s AS threshold, round(fp / n_all, 6) AS false_positive_rate, "
        "round(tp / p_all, 6) AS true_positive_rate FROM steps",
    )
    def roc(spark, sf_dir):
        points = metrics.roc_points(scored(spark, sf_dir), CHURNED, score, "w")
        return rounded(points, ["false_positive_rate", "true_positive_rate"])

    @register(
        f"precision_recall_curve_{name}",
        f"{SCORED}, {_steps(score, 'w')} SELECT s AS threshold, round(tp / (tp + fp), 6) AS precision, "
        "round(tp / p_all, 6) AS recall FROM steps",
    )
    def precision_recall(spark, sf_dir):
        points = metrics.precision_recall_points(scored(spark, sf_dir), CHURNED, score, "w")
        return rounded(points, ["precision", "recall"])

    @register(
        f"calibration_curve_{name}",
        f"{SCORED} SELECT CAST({' + '.join(f'CASE WHEN {score} > CAST({e!r} AS DOUBLE) THEN 1 ELSE 0 END' for e in metrics.BIN_EDGES)} AS INT) "
        f"AS bin, round(avg({score}), 6) AS mean_score, round(avg(CAST(churned AS DOUBLE)), 6) AS positive_share, "
        "count(*) AS bin_rows FROM scored GROUP BY 1",
    )
    def calibration(spark, sf_dir):
        points = metrics.calibration_points(scored(spark, sf_dir), CHURNED, score)
        return rounded(points, ["mean_score", "positive_share"])


_curve("fine", "p")
_curve("ties", "coarse")


def _metric_values(weight: str, score: str, by: str = "") -> str:
    """``values_``: the twelve metrics as columns, per ``by`` or overall."""
    group = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    link = f" JOIN ranked USING ({by})" if by else ", ranked"
    e = "CAST(1e-15 AS DOUBLE)"
    return (
        f"{_steps(score, weight, by)}, ranked AS (SELECT {group}sum(dfp * (tp - dtp / 2)) / (max(p_all) * max(n_all)) AS auc, "
        f"sum(dtp * tp / (tp + fp)) / max(p_all) AS average_precision FROM steps{tail}), "
        f"m AS (SELECT {group}{_cells(weight, score)} FROM scored{tail}), "
        f"rates AS (SELECT *, tp / (tp + fp + {e}) AS precision, tp / (tp + fn + {e}) AS recall, tn / (tn + fp + {e}) AS "
        "specificity FROM m), "
        f"values_ AS (SELECT {group}(tp + tn) / (tp + tn + fp + fn + {e}) AS accuracy, (recall + specificity) / 2 AS "
        f"balanced_accuracy, precision, recall, specificity, 2 * precision * recall / (precision + recall + {e}) AS f1, "
        f"fp / (fp + tn + {e}) AS false_positive_rate, fn / (fn + tp + {e}) AS false_negative_rate, average_precision, "
        f"(tp * tn - fp * fn) / (sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) + {e}) AS mcc, "
        f"tp / (sqrt((tp + fp) * (tp + fn)) + {e}) AS fowlkes_mallows_index, auc FROM rates{link})"
    )


METRIC_LIST = ", ".join(metrics.METRICS)


def _metric_query(name: str, score: str, digits: int) -> None:
    @register(
        name,
        f"{SCORED}, {_metric_values('w', score)} SELECT metric, round(v, {digits}) AS value FROM values_ UNPIVOT (v FOR "
        f"metric IN ({METRIC_LIST}))",
    )
    def query(spark, sf_dir):
        rows = _decided(scored(spark, sf_dir), score)
        return metrics.metric_rows(metrics.evaluate(rows, CHURNED, "predicted", score, "w"), digits=digits)


_metric_query("metrics", "p", 6)
_metric_query("metrics_with_ties", "coarse", 6)
_metric_query("metrics_rounded", "p", 3)


@register(
    "fold_metrics",
    f"{SCORED}, {_metric_values('fw', 'p', 'fold')} SELECT fold, metric, round(v, 6) AS value FROM values_ UNPIVOT (v FOR "
    f"metric IN ({METRIC_LIST}))",
)
def fold_metrics(spark, sf_dir):
    rows = _decided(scored_folds(spark, sf_dir))
    found = metrics.evaluate(rows, CHURNED, "predicted", "p", "fw", ["fold"])
    return metrics.metric_rows(found, ["fold"], digits=6)


@register(
    "fold_summary",
    f"{SCORED}, {_metric_values('fw', 'p', 'fold')} SELECT metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std "
    f"FROM values_ UNPIVOT (v FOR metric IN ({METRIC_LIST})) GROUP BY metric",
)
def fold_summary(spark, sf_dir):
    rows = _decided(scored_folds(spark, sf_dir))
    found = metrics.evaluate(rows, CHURNED, "predicted", "p", "fw", ["fold"])
    return rounded(metrics.fold_summary(metrics.metric_rows(found, ["fold"])), ["mean", "std"])


GRID = (
    f"{SCORED}, thresholds(t) AS (VALUES {', '.join(f'(CAST({t!r} AS DOUBLE))' for t in metrics.THRESHOLDS)}), "
    f"cells AS (SELECT t, {_cells('w', 'p', 't')} FROM scored, thresholds GROUP BY t), "
    "grid AS (SELECT t, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM cells)"
)


@register("threshold_grid", f"{GRID} SELECT round(t, 6) AS threshold, round(f1, 6) AS f1 FROM grid")
def threshold_grid(spark, sf_dir):
    return rounded(metrics.threshold_grid(scored(spark, sf_dir), CHURNED, "p", "w"), ["threshold", "f1"])


@register(
    "best_threshold",
    f"{GRID} SELECT round(t, 6) AS threshold, round(f1, 6) AS f1 FROM grid ORDER BY grid.f1 DESC, t LIMIT 1",
)
def best_threshold(spark, sf_dir):
    grid = metrics.threshold_grid(scored(spark, sf_dir), CHURNED, "p", "w")
    return rounded(metrics.best_threshold(grid), ["threshold", "f1"])


# ---- attribution and scoring without a model --------------------------------------------------------
# A fixed linear model over the lifetime averages stands in for a fitted one.

LINEAR = {name: 0.5 - 0.25 * i for i, name in enumerate(AVERAGES)}
LINEAR_ROWS = (
    f"{sql.INPUTS}, {sql.LABEL}, {SPLIT[len(LABELS) + 2:]}, lifetime AS ({sql.lifetime('counted')}), rows_ AS (SELECT * FROM "
    "lifetime JOIN parted USING (ID)), long_ AS (SELECT ID, split, feature, v FROM (SELECT ID, split, "
    + ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in AVERAGES)
    + f" FROM rows_) UNPIVOT (v FOR feature IN ({', '.join(AVERAGES)}))), "
    f"weights(feature, w) AS (VALUES {', '.join(f'({n!r}, CAST({w} AS DOUBLE))' for n, w in LINEAR.items())}), "
    "means AS (SELECT feature, avg(v) AS m FROM long_ WHERE split = 'train' GROUP BY feature), "
    "contributions AS (SELECT ID, feature, v, w * (v - m) AS contribution FROM long_ JOIN weights USING (feature) JOIN means "
    "USING (feature) WHERE split = 'test')"
)


def _linear_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    activity, attributes, holidays = inputs(spark, sf_dir)
    split = splits.stratified_split(stage(target.churn_label(activity), "labels"), CHURNED, ID)
    spans = stage(target.user_spans(activity), "spans")
    users = feature_users(spans, clean_attributes(attributes), holidays)
    rows = stage(user_features(activity, users, holidays, horizons=[]).join(split, ID), "rows")
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@register(
    "linear_attribution",
    f"{LINEAR_ROWS} SELECT feature, round(avg(contribution), 6) AS importance FROM contributions GROUP BY feature",
)
def linear_attribution(spark, sf_dir):
    train, valid = _linear_rows(spark, sf_dir)
    return rounded(attribution.linear_attribution(train, valid, LINEAR), ["importance"]).orderBy("importance")


@register(
    "contribution_summary",
    f"{LINEAR_ROWS} SELECT feature, round(avg(contribution), 6) AS mean_contribution, round(avg(abs(contribution)), 6) AS "
    "mean_abs_contribution FROM contributions GROUP BY feature",
)
def contribution_summary(spark, sf_dir):
    train, valid = _linear_rows(spark, sf_dir)
    summary = attribution.contribution_summary(attribution.linear_contributions(train, valid, LINEAR, ID))
    return rounded(summary, ["mean_contribution", "mean_abs_contribution"])


@register(
    "contribution_dependence",
    f"{LINEAR_ROWS}, span AS (SELECT feature, min(v) AS low, max(v) AS high FROM contributions GROUP BY feature) "
    "SELECT feature, CAST(coalesce(least(floor((v - low) * 10 / nullif(high - low, 0)), 9), 0) AS BIGINT) AS bin, "
    "round(avg(v), 6) AS mean_value, round(avg(contribution), 6) AS mean_contribution, count(*) AS bin_rows "
    "FROM contributions JOIN span USING (feature) GROUP BY 1, 2",
)
def contribution_dependence(spark, sf_dir):
    train, valid = _linear_rows(spark, sf_dir)
    table = attribution.dependence(attribution.linear_contributions(train, valid, LINEAR, ID))
    return rounded(table, ["mean_value", "mean_contribution"])


@register(
    "importance_filter",
    f"{LINEAR_ROWS}, ranked AS (SELECT feature, avg(contribution) AS importance FROM contributions GROUP BY feature) "
    "SELECT feature FROM ranked WHERE feature <> 'bids_places_average' AND (importance <= CAST(0.0001 AS DOUBLE) OR importance <= "
    "(SELECT importance FROM ranked WHERE feature = 'bids_places_average'))",
)
def importance_filter(spark, sf_dir):
    """Features not above a reference feature, as in the noise-referenced elimination."""
    train, valid = _linear_rows(spark, sf_dir)
    ranked = stage(attribution.linear_attribution(train, valid, LINEAR), "importances")
    bar = ranked.where(F.col("feature") == "bids_places_average").first()["importance"]
    others = [c for c in LINEAR if c != "bids_places_average"]
    weak = weak_columns(ranked, max(LEAST_IMPORTANCE, bar), others, lambda feature: feature)
    return spark.createDataFrame([(c,) for c in weak], "feature string")


@register(
    "batch_decisions",
    f"{SCORED} SELECT ID, p AS churn_probability, p > CAST(0.5 AS DOUBLE) AS prediction, round(CASE WHEN p > CAST(0.5 AS DOUBLE) "
    "THEN p ELSE 1 - p END, 9) AS predicted_class_probability FROM scored",
)
def batch_decisions(spark, sf_dir):
    rows = scored(spark, sf_dir).select(ID, F.col("p").alias("churn_probability"))
    return rounded(decide(rows), ["predicted_class_probability"], 9)


@register(
    "prediction_messages",
    f"{SCORED} SELECT ID, printf('prediction for user %d is %s with probability of: %.3f', ID, CASE WHEN p > "
    "CAST(0.5 AS DOUBLE) THEN 'True' ELSE 'False' END, CASE WHEN p > CAST(0.5 AS DOUBLE) THEN p ELSE 1 - p END) AS message "
    "FROM scored",
)
def prediction_messages(spark, sf_dir):
    rows = scored(spark, sf_dir).select(ID, F.col("p").alias("churn_probability"))
    return with_message(decide(rows)).select(ID, "message")
