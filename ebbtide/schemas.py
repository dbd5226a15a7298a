"""Column names and types of the churn domain."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "ID"
START = "start_date_of_week"
COUNTRY = "country"
DEVICE = "mobile_device"
CHURNED = "churned"
LAST_ACTIVITY = "last_activity"
HOLIDAY = "holiday"
HOLIDAY_COUNT = "holiday_count"

# The seven measured columns, the five statistics in output order, the horizons in days.
COUNT_COLUMNS = ["unique_lots_viewed", "amount_views", "bidded_on_amount_lots", "bids_places"]
MONEY_COLUMNS = ["total_bidded", "money_spend", "amount_lots_won"]
MEASURES = COUNT_COLUMNS + MONEY_COLUMNS
STATISTICS = ["average", "min", "max", "median", "sum"]
HORIZONS = [30, 90, 180, 365]
ATTRIBUTES = [DEVICE, COUNTRY, "preferred_language", "gender", "is_company"]
CHURN_AFTER_DAYS = 365

ACTIVITY_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.LongType()),
        T.StructField("week", T.ShortType()),
        T.StructField("year", T.IntegerType()),
        T.StructField(START, T.DateType()),
        *[T.StructField(name, T.IntegerType()) for name in COUNT_COLUMNS],
        *[T.StructField(name, T.DoubleType()) for name in MONEY_COLUMNS],
        T.StructField("platform", T.StringType()),
    ]
)

ATTRIBUTES_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.LongType()),
        T.StructField(DEVICE, T.StringType()),
        T.StructField(COUNTRY, T.StringType()),
        T.StructField("preferred_language", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("is_company", T.BooleanType()),
    ]
)

HOLIDAY_SCHEMA = T.StructType(
    [T.StructField(COUNTRY, T.StringType()), T.StructField(HOLIDAY, T.DateType())]
)


def horizon_suffix(days: int | None) -> str:
    return "" if days is None else f"_last_{days}_days"


def feature_name(measure: str, statistic: str, days: int | None) -> str:
    return f"{measure}_{statistic}{horizon_suffix(days)}"


def holiday_feature(days: int) -> str:
    return f"num_of_holidays_in_the_last_{days}_days"


def lifetime_feature_names() -> list[str]:
    return [feature_name(m, s, None) for s in STATISTICS for m in MEASURES]


def horizon_feature_names(days: int) -> list[str]:
    return [feature_name(m, s, days) for s in STATISTICS for m in MEASURES] + [holiday_feature(days)]


def numeric_feature_names(horizons: list[int] = HORIZONS) -> list[str]:
    names = ["num_of_active_weeks", "days_subscribed", *lifetime_feature_names()]
    for days in horizons:
        names += horizon_feature_names(days)
    return names
