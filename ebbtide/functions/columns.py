"""Column selectors, bulk casts and null handling driven by the schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns; booleans are not among them."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def lower_strings(df: DataFrame) -> DataFrame:
    names = string_columns(df)
    return df.withColumns({name: F.lower(F.col(name)) for name in names}) if names else df


def doubles_to_floats(df: DataFrame) -> DataFrame:
    return df.selectExpr(
        *[
            f"CAST(`{f.name}` AS FLOAT) AS `{f.name}`" if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema
        ]
    )


def fill_numeric_nulls(df: DataFrame) -> DataFrame:
    """Nulls in numeric columns become 0; strings, dates and booleans stay as they are."""
    return df.na.fill(0)


def drop_by_suffix(df: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    return df.drop(*[name for name in df.columns if name.endswith(suffixes)])


def with_noise(df: DataFrame, name: str = "noise", seed: int = 42) -> DataFrame:
    """A standard-normal control column."""
    return df.withColumn(name, F.randn(seed))


def long_form(df: DataFrame, columns: list[str], keep: list[str] | None = None, name: str = "column") -> DataFrame:
    """``keep..., name, value`` with one row per row and column. Grouping it by ``name`` aggregates any
    number of columns with one small set of partial aggregates instead of one set per column."""
    entries = ", ".join(f"struct('{c}' AS {name}, CAST(`{c}` AS DOUBLE) AS value)" for c in columns)
    return df.select(*(keep or []), F.expr(f"inline(array({entries}))"))
