"""Changes of a user's own login behaviour over time.

A user's daily counts are compared with the user's own trailing level by two
cumulative sums, one for more and one for fewer logins: S = max(0, S + d), where d is
what the day exceeds the level by beyond the allowance.  S is the running sum of d
minus its running minimum (or zero), so no state is carried from day to day: it is
two running extremes over the user's days.  A shift is a stretch of days with S
above zero on which S passes the limit.

Logins shrink to (user, day) cells before any ordering: however busy a user is,
there are as many rows as days.  All amounts are whole units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from watchledger.workspace import materialize

#: Units of one login.
UNIT = 1000


def daily_counts(logins: DataFrame, failures_only: bool = False) -> DataFrame:
    """user_id, day, logins for every day from the user's first to the last day of all, zero where nothing happened."""
    known = logins.where("user_id is not null and login_time is not null")
    counted = F.col("success") == "No" if failures_only else F.lit(True)
    cells = known.groupBy("user_id", F.to_date("login_time").alias("day")).agg(F.sum(F.when(counted, 1).otherwise(0)).alias("logins"))
    cells = materialize(cells, "user-days")
    last = cells.agg(F.max("day").alias("d")).scalar()
    spans = cells.groupBy("user_id").agg(F.min("day").alias("first")).withColumn("day", F.explode(F.sequence("first", last))).drop("first")
    return spans.join(cells, ["user_id", "day"], "left").withColumn("logins", F.coalesce("logins", F.lit(0)))


def login_shifts(logins: DataFrame, failures_only: bool = False, memory: int = 7, share: float = 0.5, slack: float = 1.0, limit: float = 5.0) -> DataFrame:
    """First day, alarm day and size of every lasting change of a user's daily logins.

    The level is the mean of the ``memory`` days before; a day may differ from it by
    ``share`` of it and ``slack`` logins.  The limit is in logins added up beyond that.
    ``excess`` is the greatest S, ``level_before`` the level on the first day,
    ``level_during`` the mean from the first day to the day of the greatest S.
    """
    days = daily_counts(logins, failures_only)
    by_day = Window.partitionBy("user_id").orderBy("day")
    before = by_day.rowsBetween(-memory, -1)
    level = F.floor(F.sum("logins").over(before) * UNIT / memory)
    levels = days.withColumn("level", F.when(F.count("logins").over(before) == memory, level)).where("level is not null")
    allowed = F.floor(F.col("level") * share) + int(slack * UNIT)
    x = F.col("logins") * UNIT
    upto = by_day.rowsBetween(Window.unboundedPreceding, 0)

    def side(name: str, beyond: Column) -> DataFrame:
        summed = levels.withColumn("total", F.sum(beyond).over(upto))
        reached = summed.withColumn("s", F.col("total") - F.least(F.lit(0), F.min("total").over(upto)))
        return reached.withColumn("stretch", F.sum(F.when(F.col("s") == 0, 1).otherwise(0)).over(upto)).where("s > 0").select(
            "user_id", F.lit(name).alias("direction"), "day", "logins", "level", "s", "stretch",
            F.sum("logins").over(Window.partitionBy("user_id", "stretch").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"))

    both = side("more", x - F.col("level") - allowed).unionAll(side("fewer", F.col("level") - allowed - x))
    peak = F.max_by(F.struct("day", "so_far"), F.struct("s", -F.unix_date("day")))
    found = both.groupBy("user_id", "direction", "stretch").agg(
        F.min("day").alias("first_day"), F.min(F.when(F.col("s") > int(limit * UNIT), F.col("day"))).alias("alarm_day"), F.max("day").alias("last_day"),
        F.max("s").alias("s"), F.min_by("level", "day").alias("level"), peak.alias("peak"))
    return found.where("alarm_day is not null").select(
        "user_id", "direction", "first_day", "alarm_day", "last_day", (F.col("s") / UNIT).alias("excess"), (F.col("level") / UNIT).alias("level_before"),
        (F.col("peak.so_far") / (F.date_diff("peak.day", "first_day") + 1)).alias("level_during"))
