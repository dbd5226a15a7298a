"""Activity, attribute, holiday and feature tables: reading, filtering by user, writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ebbtide.schemas import ACTIVITY_SCHEMA, ATTRIBUTES_SCHEMA, HOLIDAY_SCHEMA, ID
from ebbtide.session import broadcast_if_small, release, stage


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    found = spark.read.format(fmt).load(path)
    return found.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_activity(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Weekly activity with its fixed 12-column schema."""
    return _read(spark, path, ACTIVITY_SCHEMA, fmt)


def read_attributes(
    spark: SparkSession, path: str, fmt: str = "csv", infer_schema: bool = False
) -> DataFrame:
    """User attributes. ``infer_schema`` accepts files with more or other columns at the price of
    one more pass over them."""
    if infer_schema and fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return _read(spark, path, ATTRIBUTES_SCHEMA, fmt)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, HOLIDAY_SCHEMA, "parquet")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def for_users(df: DataFrame, users: int | list[int] | DataFrame) -> DataFrame:
    """Rows of the asked users. Literal IDs become a predicate pushed to the scan; a table of IDs
    becomes a left-semi join, broadcast only when it was counted and is short."""
    if isinstance(users, DataFrame):
        return df.join(broadcast_if_small(users.select(ID).distinct()), ID, "left_semi")
    wanted = [users] if isinstance(users, int) else list(users)
    return df.where(F.col(ID).isin(wanted))


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def write_table(df: DataFrame, path: str, reuse: bool = False, order_by: str | None = None) -> DataFrame:
    """Write ``df`` to parquet and read it back, so that nothing downstream recomputes it. ``order_by`` deals the rows
    out by ranges of a column and sorts each file, so that later look-ups read few files. The rows are then written
    as they come first, since finding the ranges would compute them once more.

    ``reuse=True`` returns a table already at ``path`` without looking at its age; the default
    replaces it.
    """
    spark = df.sparkSession
    if not (reuse and table_exists(spark, path)):
        if order_by is None:
            df.write.mode("overwrite").parquet(path)
        else:
            found = stage(df, "unordered")
            found.repartitionByRange(order_by).sortWithinPartitions(order_by).write.mode("overwrite").parquet(path)
            release(found)
    return spark.read.parquet(path)
