"""The churn inputs as views over a retail star schema (orders, lineitem, customer, nation).

An order line stands for a lot viewed, a discounted line for a bid and a returned line for a won lot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.operators.holidays import holiday_dimension
from ebbtide.schemas import ACTIVITY_SCHEMA, ATTRIBUTES_SCHEMA, COUNTRY, ID, START

# Fixed values of the test calendar: public holidays as (month, day), years covered, and the nation
# key from which on nations have no calendar.
HOLIDAY_DAYS = [(1, 1), (5, 1), (12, 25), (12, 26)]
HOLIDAY_YEARS = list(range(1995, 2002))
FIRST_NATION_WITHOUT_CALENDAR = 20
BID_DISCOUNT = 0.05


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    # The week belongs to the order, of which there are fewer; an order of no customer joins none in the end.
    weeks = orders.where(F.col("o_custkey").isNotNull()).select(
        "o_orderkey", F.col("o_custkey").alias(ID), F.date_trunc("week", "o_orderdate").cast("date").alias(START)
    )
    bid, won = F.col("bid"), F.col("won")
    views = lines.select(
        "l_orderkey", "l_partkey", "l_extendedprice",
        (F.col("l_discount") > BID_DISCOUNT).alias("bid"), (F.col("l_returnflag") == "R").alias("won"),
    )
    # One row per lot and week first: distinct counts then are plain counts of those rows. Orders are the short side and
    # hold a key once, so that each task looks its lines up and sorts neither.
    lots = (
        views.join(weeks.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(ID, START, "l_partkey")
        .agg(
            F.count(F.lit(1)).alias("views"),
            F.count_if(bid).alias("bids"),
            F.count_if(won).alias("wins"),
            F.sum(F.when(bid, F.col("l_extendedprice")).otherwise(0)).alias("bid_money"),
            F.sum(F.when(won, F.col("l_extendedprice")).otherwise(0)).alias("won_money"),
        )
    )
    weekly = (
        lots.groupBy(ID, START)
        .agg(
            F.count("l_partkey").alias("unique_lots_viewed"),
            F.sum("views").alias("amount_views"),
            F.count_if(F.col("bids") > 0).alias("bidded_on_amount_lots"),
            F.sum("bids").alias("bids_places"),
            F.round(F.sum("bid_money"), 2).alias("total_bidded"),
            F.round(F.sum("won_money"), 2).alias("money_spend"),
            F.sum("wins").alias("amount_lots_won"),
        )
        .join(customers, F.col(ID) == F.col("c_custkey"))
        .withColumnRenamed("c_mktsegment", "platform")
        .withColumns({"week": F.weekofyear(START), "year": F.year(START)})
    )
    return weekly.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in ACTIVITY_SCHEMA])


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    device = (
        F.when(key % 7 == 0, F.lit(None))
        .when(key % 3 == 0, "iPhone")
        .when(key % 3 == 1, "Android")
        .otherwise("iPad")
    )
    region = F.col("n_regionkey")
    language = (
        F.when(region == 0, "EN").when(region == 1, "NL").when(region == 2, "DE").when(region == 3, "FR").otherwise("IT")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            key.alias(ID),
            device.alias("mobile_device"),
            F.col("n_name").alias(COUNTRY),
            language.alias("preferred_language"),
            F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
            F.col("c_mktsegment").isin("MACHINERY", "BUILDING").alias("is_company"),
        )
        .select([F.col(f.name).cast(f.dataType).alias(f.name) for f in ATTRIBUTES_SCHEMA])
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holiday rules ``(country_code, month, day)``; the last nations have none on purpose."""
    days = F.array(*[F.struct(F.lit(m).alias("month"), F.lit(d).alias("day")) for m, d in HOLIDAY_DAYS])
    return (
        table(spark, sf_dir, "nation")
        .where(F.col("n_nationkey") < FIRST_NATION_WITHOUT_CALENDAR)
        .select(F.upper("n_name").alias("country_code"), F.inline(days))
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holiday dimension of every country that occurs in ``nation``."""
    countries = table(spark, sf_dir, "nation").select(F.lower("n_name").alias(COUNTRY))
    return holiday_dimension(countries, calendar(spark, sf_dir), HOLIDAY_YEARS)


def event_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly activity of the event stream: five weeks, other users, for short horizons."""
    bought = F.col("event_type") == "purchase"
    weekly = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias(ID), F.date_trunc("week", "ts").cast("date").alias(START))
        .agg(
            F.count(F.lit(1)).alias("amount_views"),
            F.sum(F.when(bought, 1).otherwise(0)).alias("bids_places"),
            F.round(F.sum(F.when(bought, F.col("value")).otherwise(0)), 2).alias("money_spend"),
        )
    )
    present = set(weekly.columns)
    return weekly.select(
        [
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ACTIVITY_SCHEMA
        ]
    )
