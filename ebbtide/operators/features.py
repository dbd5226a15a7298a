"""The wide per-user feature row: lifetime statistics and statistics of four horizons.

All horizons come out of one shuffle of the activity by user: the rows lie sorted by user, and a task
computes all statistics of all horizons of whole users (:mod:`.user_statistics`), without a copy of a
row per horizon.

Row counts per user (from :func:`user_spans`) decide how a user is handled:

* ordinary users: one shuffle of the activity by user, all statistics by the task that has the rows;
* users above ``Limits.median_rows``: medians by :func:`exact_quantiles`, everything else as before;
* users above ``Limits.hot_share`` of all rows or above ``Limits.task_rows``, whichever is less: their
  rows never meet in one task. Their attributes are broadcast in blocks of a counted size, the rows
  stay where they are, and partial aggregates are shuffled in two levels: first by user and salt, with
  one salt for every ``task_rows`` rows the user has, then by user.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.holidays import attach_holiday_counts, keep_supported
from ebbtide.operators.quantiles import exact_quantiles
from ebbtide.operators.target import USER_ROWS
from ebbtide.operators.user_statistics import statistics_by_user
from ebbtide.schemas import (
    COUNTRY,
    HOLIDAY_COUNT,
    HORIZONS,
    ID,
    LAST_ACTIVITY,
    MEASURES,
    START,
    STATISTICS,
    feature_name,
    holiday_feature,
)
from ebbtide.session import BROADCAST_ROWS, broadcast_if_small, stage

LIFETIME = 0
_DAYS = "_days"
_SALT = "_salt"
_HOLIDAYS = "holidays"


@dataclass(frozen=True)
class Limits:
    median_rows: int = 10_000
    hot_share: float = 1e-4
    task_rows: int = 1_000_000

    def hot_rows(self, total: int) -> int:
        """Rows a user may have in one task, never more than ``task_rows`` however large the data."""
        return max(self.median_rows, min(self.task_rows, int(total * self.hot_share)))


def _per_horizon(rows: DataFrame, horizons: list[int], carry: list[str]) -> DataFrame:
    """Each row once for the lifetime and once per horizon it lies in, counted back from the user's
    own last active week, bounds included. Only users that are aggregated in parts are copied like this."""
    age = F.datediff(LAST_ACTIVITY, START)
    spans = [F.lit(LIFETIME), *[F.when(age <= days, F.lit(days)) for days in horizons]]
    return rows.select(
        ID, *carry, START, USER_ROWS, *MEASURES, HOLIDAY_COUNT,
        F.explode(F.array_compact(F.array(*spans))).alias(_DAYS),
    )


def _sources(horizons: list[int]) -> dict[str, tuple[int, str]]:
    """Where each output feature comes from: horizon and name of the statistic in it."""
    found = {"num_of_active_weeks": (LIFETIME, "num_of_active_weeks"), "days_subscribed": (LIFETIME, "days_subscribed")}
    for days in [LIFETIME, *horizons]:
        for statistic in STATISTICS:
            for name in MEASURES:
                found[feature_name(name, statistic, days or None)] = (days, f"{name}_{statistic}")
        if days:
            found[holiday_feature(days)] = (days, _HOLIDAYS)
    return found


def _aggregate(
    rows: DataFrame, horizons: list[int], carry: list[str], median_limit: int | None
) -> DataFrame:
    """One row per user with the statistics of every horizon. Carried columns depend on the user
    alone, so grouping by them too changes no group and saves the joins that would attach them to
    the wide row."""
    ranked = F.lit(True) if median_limit is None else F.col(USER_ROWS) <= median_limit
    return statistics_by_user(rows, [ID, *carry], MEASURES, START, LAST_ACTIVITY, HOLIDAY_COUNT, ranked, horizons)


def _salted_aggregate(rows: DataFrame, horizons: list[int], carry: list[str], task_rows: int) -> DataFrame:
    """:func:`_aggregate` without medians for users of any size. The salt is taken from the number of the
    task that holds the row, so a task sends one partial row per (user, horizon) at most; a user of ``n``
    rows has ``n / task_rows`` salts, and that many rows meet at the second level."""
    salts = F.ceil(F.col(USER_ROWS) / F.lit(task_rows))
    salted = rows.withColumn(_SALT, F.pmod(F.spark_partition_id(), salts))
    first, second = [], []
    for name in MEASURES:
        first += [f"sum({name}) AS {name}_sum", f"count({name}) AS {name}_rows",
                  f"min({name}) AS {name}_min", f"max({name}) AS {name}_max"]
        second += [f"sum({name}_sum) / nullif(sum({name}_rows), 0) AS {name}_average", f"min({name}_min) AS {name}_min",
                   f"max({name}_max) AS {name}_max", f"CAST(NULL AS DOUBLE) AS {name}_median", f"sum({name}_sum) AS {name}_sum"]
    first += [f"count({START}) AS weeks", f"min({START}) AS first_start", f"max({START}) AS last_start",
              f"sum({HOLIDAY_COUNT}) AS {_HOLIDAYS}"]
    second += ["sum(weeks) AS num_of_active_weeks", "datediff(max(last_start), min(first_start)) AS days_subscribed",
               f"sum({_HOLIDAYS}) AS {_HOLIDAYS}"]
    parts = _per_horizon(salted, horizons, [*carry, _SALT]).groupBy(ID, *carry, _DAYS, _SALT).agg(*map(F.expr, first))
    return _side_by_side(parts.groupBy(ID, *carry, _DAYS).agg(*map(F.expr, second)), horizons, carry)


def _side_by_side(long: DataFrame, horizons: list[int], carry: list[str]) -> DataFrame:
    """The columns of :func:`_aggregate` out of one row per user and horizon."""
    wanted = dict.fromkeys(_sources(horizons).values())
    names = list(dict.fromkeys(statistic for _, statistic in wanted))
    packed = long.select(ID, *carry, _DAYS, F.struct(*names).alias("_stats"))
    laid = packed.groupBy(ID, *carry).agg(
        *[F.expr(f"any_value(_stats) FILTER (WHERE {_DAYS} = {d}) AS _d{d}") for d in [LIFETIME, *horizons]]
    )
    return laid.select(ID, *carry, *[F.col(f"_d{days}.{statistic}").alias(f"d{days}_{statistic}") for days, statistic in wanted])


def _large_medians(rows: DataFrame, horizons: list[int], largest_group: int) -> DataFrame:
    """Medians of users with many rows: one row per user with a map from feature to median."""
    values = [
        F.struct(F.lit(f"{name}_median").alias("statistic"), F.col(name).cast("double").alias("value"))
        for name in MEASURES
    ]
    long = _per_horizon(rows, horizons, []).select(ID, _DAYS, F.inline(F.array(*values)))
    medians = exact_quantiles(long, [ID, _DAYS, "statistic"], "value", [0.5], largest_group)
    entry = F.struct(F.concat_ws(":", _DAYS, "statistic"), F.col("quantiles")[0])
    return medians.groupBy(ID).agg(F.map_from_entries(F.collect_list(entry)).alias("_medians"))


def _flat(
    wide: DataFrame, horizons: list[int], carry: list[str], large_medians: bool = False
) -> DataFrame:
    columns = []
    for target, (days, statistic) in _sources(horizons).items():
        options = [f"d{days}_{statistic}"]
        if large_medians and statistic.endswith("_median"):
            options.append(f"_medians['{days}:{statistic}']")
        columns.append(f"coalesce({', '.join(options)}, 0) AS {target}")
    return wide.selectExpr(ID, *columns, *carry)


def feature_users(
    spans: DataFrame, attributes: DataFrame, holidays: DataFrame, unsupported_country: str = "drop"
) -> DataFrame:
    """Spans and attributes of the users that get features: with ``drop`` those whose country has
    holidays, with ``zero`` all. ``attributes`` are cleaned and hold a user once."""
    if unsupported_country == "drop":
        return spans.join(keep_supported(attributes, holidays, unsupported_country), ID)
    return spans.join(keep_supported(attributes, holidays, unsupported_country), ID, "left")


def _hot_blocks(users: DataFrame, hot_rows: int) -> list[DataFrame]:
    """The users above ``hot_rows`` in blocks that can be broadcast. One block holds them all until the
    activity has some ``BROADCAST_ROWS / 2 * hot_rows`` rows; each further block is one more scan."""
    hot = stage(users.where(F.col(USER_ROWS) > hot_rows), "hot-users")
    blocks = hot.count() // (BROADCAST_ROWS // 2) + 1
    block = F.pmod(F.xxhash64(ID), F.lit(blocks))
    return [broadcast_if_small(hot.where(block == k)) for k in range(blocks)]


def user_features(
    activity: DataFrame,
    users: DataFrame,
    holidays: DataFrame,
    carry: list[str] | None = None,
    horizons: list[int] = HORIZONS,
    limits: Limits = Limits(),
) -> DataFrame:
    """``ID``, the numeric features (nulls replaced by 0) and the carried columns of every user.

    ``users`` comes from :func:`feature_users`, best as a written table: its row counts are read
    first to see whether any user is large.
    """
    carry = carry or []
    activity = activity.select(ID, START, *MEASURES)
    users = users.select(ID, LAST_ACTIVITY, USER_ROWS, *dict.fromkeys([COUNTRY, *carry]))
    size = users.agg(F.sum(USER_ROWS).alias("total"), F.max(USER_ROWS).alias("largest")).first()
    largest, total = size["largest"] or 0, size["total"] or 0

    def enriched(part: DataFrame, people: DataFrame) -> DataFrame:
        return attach_holiday_counts(part.join(people, ID), holidays)

    if largest <= limits.median_rows:
        return _flat(_aggregate(enriched(activity, users), horizons, carry, None), horizons, carry)

    hot_rows = limits.hot_rows(total)
    cold, heavy = activity, None
    for block in _hot_blocks(users, hot_rows):
        cold = cold.join(block.select(ID), ID, "left_anti")
        found = enriched(activity, block)
        heavy = found if heavy is None else heavy.unionByName(found)
    wide = _aggregate(enriched(cold, users), horizons, carry, limits.median_rows).unionByName(
        _salted_aggregate(heavy, horizons, carry, limits.task_rows)
    )

    # Counted and broadcast while there are few of them, so that the activity is not shuffled again.
    large = broadcast_if_small(
        stage(users.where(F.col(USER_ROWS).between(limits.median_rows + 1, hot_rows)), "large-users")
    )
    medians = _large_medians(enriched(cold, large).unionByName(heavy), horizons, largest)
    return _flat(wide.join(medians, ID, "left"), horizons, carry, large_medians=True)
