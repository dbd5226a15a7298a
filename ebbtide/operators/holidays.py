"""Public holidays: dimension table and number of holidays in each user's active week.

A holiday ``h`` falls into the week ``start .. start + 6`` exactly when ``start`` is one of the seven days ``h - 6 ..
h``. Each country has one row: its days as bits, in words of 64 days of which a new one begins every 32, so that any
week lies in one word. Counting a week's holidays is then a look-up and a bit count over seven bits in the task that
has the activity; nothing is exchanged by country and week. A day that is listed several times has its number of rows
in binary, one set of words for each binary digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.schemas import COUNTRY, HOLIDAY, HOLIDAY_COUNT, START
from ebbtide.session import broadcast_if_small, stage

DAYS_IN_WEEK = 7
_STRIDE, _WORD = 32, 64  # days from one word to the next, and days of a word


def holiday_dimension(users: DataFrame, calendar: DataFrame, years: list[int]) -> DataFrame:
    """Holidays of the countries that occur among ``users``.

    ``calendar`` holds the rules ``(country_code, month, day)`` with upper-case codes. A null country
    and a country without rules yield no row.
    """
    countries = users.select(COUNTRY).where(F.col(COUNTRY).isNotNull()).distinct()
    year_list = F.array(*[F.lit(y) for y in years])
    return (
        countries.withColumn("country_code", F.upper(COUNTRY))
        .join(calendar, "country_code")
        .withColumn("year", F.explode(year_list))
        .select(COUNTRY, F.make_date("year", "month", "day").alias(HOLIDAY))
        .distinct()
    )


def holidays_by_week_start(holidays: DataFrame) -> DataFrame:
    """``(country, start, holiday_count)`` for every start day whose week holds a holiday."""
    first_start = F.date_sub(HOLIDAY, DAYS_IN_WEEK - 1)
    return (
        holidays.where(F.col(HOLIDAY).isNotNull())
        .select(COUNTRY, F.explode(F.sequence(first_start, F.col(HOLIDAY))).alias(START))
        .groupBy(COUNTRY, START)
        .agg(F.count(F.lit(1)).alias(HOLIDAY_COUNT))
    )


def supported_countries(holidays: DataFrame) -> DataFrame:
    return holidays.select(COUNTRY).where(F.col(COUNTRY).isNotNull()).distinct()


def keep_supported(users: DataFrame, holidays: DataFrame, unsupported_country: str) -> DataFrame:
    """``drop`` removes rows of countries without any holiday (and of no country); ``zero`` keeps
    them, so that they later count 0 holidays."""
    if unsupported_country == "zero":
        return users
    if unsupported_country != "drop":
        raise ValueError("unsupported_country must be 'drop' or 'zero'")
    return users.join(broadcast_if_small(supported_countries(holidays)), COUNTRY, "left_semi")


def add_holiday_counts(
    activity: DataFrame, holidays: DataFrame, unsupported_country: str = "drop"
) -> DataFrame:
    """Activity rows (with their country) plus ``holiday_count``; a null start day counts 0."""
    kept = keep_supported(activity, holidays, unsupported_country)
    return attach_holiday_counts(kept, holidays)


def holiday_words(holidays: DataFrame) -> tuple[DataFrame, int]:
    """One row for each country (country, _first, _words_0, _words_1, ...): the number of its first word, and for each
    binary digit of the number of rows of a day the words from there on. Also gives the number of digits."""
    days = (
        holidays.where(F.col(HOLIDAY).isNotNull() & F.col(COUNTRY).isNotNull())
        .groupBy(COUNTRY, F.datediff(F.col(HOLIDAY), F.lit("1970-01-01").cast("date")).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    digits = int(days.agg(F.max("_rows")).first()[0] or 1).bit_length()
    last = F.floor(F.col("_day") / _STRIDE)
    placed = days.select(COUNTRY, "_rows", "_day", F.explode(F.array(last - 1, last)).alias("_word"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_day") - F.col("_word") * _STRIDE).cast("int"))
    masks = [F.bit_or(F.when(F.call_function("shiftright", "_rows", F.lit(p)) % 2 == 1, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"_mask_{p}") for p in range(digits)]
    words = placed.groupBy(COUNTRY, "_word").agg(*masks)
    # A country's calendar is bounded by the days there are; its words are few whatever the activity.
    entry = F.struct(F.col("_word"), *[F.col(f"_mask_{p}") for p in range(digits)])
    gathered = words.groupBy(COUNTRY).agg(F.min("_word").alias("_first"), F.max("_word").alias("_last"), F.collect_list(entry).alias("_entries"))
    every = F.sequence("_first", "_last")

    def dense(mask: str) -> Column:
        known = F.map_from_entries(F.transform("_entries", lambda entry: F.struct(entry["_word"], entry[mask])))
        return F.transform(every, lambda word: F.coalesce(F.try_element_at(known, word), F.lit(0).cast("bigint")))

    return gathered.select(COUNTRY, "_first", *[dense(f"_mask_{p}").alias(f"_words_{p}") for p in range(digits)]), digits


def attach_holiday_counts(rows: DataFrame, holidays: DataFrame) -> DataFrame:
    words, digits = holiday_words(holidays)
    words = stage(words.withColumnRenamed(COUNTRY, "_country"), "holiday-words")
    start = F.datediff(F.col(START).cast("date"), F.lit("1970-01-01").cast("date"))
    word = F.floor(start / _STRIDE)
    place, shift = (word - F.col("_first")).cast("int"), (start - word * _STRIDE).cast("int")
    count = F.lit(0)
    for p in range(digits):
        week = F.call_function("shiftrightunsigned", F.get(f"_words_{p}", place), shift).bitwiseAND(F.lit((1 << DAYS_IN_WEEK) - 1))
        count = count + F.bit_count(week) * (1 << p)
    joined = rows.join(broadcast_if_small(words), F.col(COUNTRY) == F.col("_country"), "left")
    return joined.withColumn(HOLIDAY_COUNT, F.coalesce(count, F.lit(0)).cast("bigint")).drop("_country", "_first", *[f"_words_{p}" for p in range(digits)])
