"""Whole jobs: the labelled training table and the feature table for scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ebbtide.operators.attributes import clean_attributes
from ebbtide.operators.features import Limits, feature_users, user_features
from ebbtide.operators.target import user_spans, with_label
from ebbtide.schemas import (
    ATTRIBUTES,
    CHURN_AFTER_DAYS,
    CHURNED,
    HORIZONS,
    ID,
    numeric_feature_names,
)
from ebbtide.session import stage
from ebbtide.sources.readers import for_users, read_features, table_exists, write_table


def feature_columns(horizons: list[int] = HORIZONS) -> list[str]:
    return [*numeric_feature_names(horizons), *ATTRIBUTES]


def training_table(
    activity: DataFrame,
    attributes: DataFrame,
    holidays: DataFrame,
    unsupported_country: str = "drop",
    horizons: list[int] = HORIZONS,
    churn_after_days: int = CHURN_AFTER_DAYS,
    limits: Limits = Limits(),
) -> DataFrame:
    """188 columns per user: ID, 181 numeric features, 5 attributes and the label.

    The label looks at all activity, also at that of users whose country has no calendar; those users
    only drop out of the features. Both come from the same user spans, written once.
    """
    spans = with_label(stage(user_spans(activity), "spans"), churn_after_days)
    users = stage(feature_users(spans, clean_attributes(attributes), holidays, unsupported_country), "users")
    carry = [*ATTRIBUTES, CHURNED]
    features = user_features(activity, users, holidays, carry, horizons, limits)
    return features.select(ID, *feature_columns(horizons), CHURNED)


def scoring_table(
    activity: DataFrame,
    attributes: DataFrame,
    holidays: DataFrame,
    users: int | list[int] | DataFrame | None = None,
    unsupported_country: str = "drop",
    horizons: list[int] = HORIZONS,
    limits: Limits = Limits(),
) -> DataFrame:
    """The same features without label, for all users or for the asked ones only. The restriction
    reaches both scans, and a user's row equals the one in the training table."""
    if isinstance(users, DataFrame):
        users = stage(users.select(ID).distinct(), "asked-users")
    if users is not None:
        activity, attributes = for_users(activity, users), for_users(attributes, users)
    spans = stage(user_spans(activity), "spans")
    users = feature_users(spans, clean_attributes(attributes), holidays, unsupported_country)
    features = user_features(activity, users, holidays, ATTRIBUTES, horizons, limits)
    return features.select(ID, *feature_columns(horizons))


def build_training_table(
    activity: DataFrame,
    attributes: DataFrame,
    holidays: DataFrame,
    path: str,
    reuse: bool = False,
    **options,
) -> DataFrame:
    """Training table written to ``path``, ordered by user, and read back. With ``reuse`` a table already there is
    returned as it is."""
    spark = activity.sparkSession
    if reuse and table_exists(spark, path):
        return read_features(spark, path)
    return write_table(training_table(activity, attributes, holidays, **options), path, order_by=ID)

