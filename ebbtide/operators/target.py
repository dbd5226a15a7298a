"""User spans (first and last week, row count) and the churn label derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.schemas import CHURN_AFTER_DAYS, CHURNED, ID, LAST_ACTIVITY, START

USER_ROWS = "user_rows"


def user_spans(activity: DataFrame) -> DataFrame:
    """One row per user: last active week and number of activity rows.

    Every aggregate combines on the map side, so one user with a third of all rows costs no more
    than one partial row per map task. Rows without a user are left out: they have no attributes,
    hence no country, and take no part in features or labels.
    """
    return (
        activity.where(F.col(ID).isNotNull())
        .groupBy(ID)
        .agg(F.max(START).alias(LAST_ACTIVITY), F.count(F.lit(1)).alias(USER_ROWS))
    )


def _inactive_longer_than(reference: Column, days: int) -> Column:
    return F.when(F.datediff(reference, F.col(LAST_ACTIVITY)) > days, F.lit(True)).otherwise(F.lit(False))


def with_label(spans: DataFrame, after_days: int = CHURN_AFTER_DAYS) -> DataFrame:
    newest = spans.agg(F.max(LAST_ACTIVITY)).scalar()
    return spans.withColumn(CHURNED, _inactive_longer_than(newest, after_days))


def churn_label(activity: DataFrame, after_days: int = CHURN_AFTER_DAYS) -> DataFrame:
    """Churned: the user's last week lies more than ``after_days`` before the newest week of all.
    A user without any date is not churned."""
    return with_label(user_spans(activity), after_days).select(ID, CHURNED)


def churn_as_of(activity: DataFrame, as_of: str, after_days: int = CHURN_AFTER_DAYS) -> DataFrame:
    """The label seen from a given day instead of from the newest week in the data."""
    day = F.lit(as_of).cast("date")
    return user_spans(activity).select(ID, _inactive_longer_than(day, after_days).alias(CHURNED))


def with_last_activity(activity: DataFrame) -> DataFrame:
    """Every activity row with its user's last active week."""
    return activity.join(user_spans(activity).drop(USER_ROWS), ID, "left")
