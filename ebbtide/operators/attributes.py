"""Cleaning of user attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import lower_strings
from ebbtide.schemas import DEVICE


def clean_attributes(attributes: DataFrame) -> DataFrame:
    """Lower-case every string column; an absent device becomes ``unknown``. Other nulls stay."""
    return lower_strings(attributes).withColumn(DEVICE, F.coalesce(F.col(DEVICE), F.lit("unknown")))
