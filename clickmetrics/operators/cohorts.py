"""Acquisition cohorts: users by the day they were first seen."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.functions import day_text
from clickmetrics.operators.activity import FIRST_AT, as_activity

NullPolicy = Literal["drop_null_day", "keep_null_day"]


def user_signup(events: DataFrame) -> DataFrame:
    """First time each user was seen."""
    return as_activity(events).groupBy("user_id").agg(F.min(FIRST_AT).alias("signup_date"))


def cohort_daily(events: DataFrame, null_policy: NullPolicy = "drop_null_day") -> DataFrame:
    """Users per first-seen day, the day as text.

    ``drop_null_day`` leaves out users never seen at a known time and counts a null user as
    one user; ``keep_null_day`` gives such users a null day of their own and does not
    count a null user.
    """
    first_days = user_signup(events).select(
        "user_id", day_text(F.col("signup_date")).alias("cohort_day")
    )
    if null_policy == "drop_null_day":
        known = first_days.filter(F.col("cohort_day").isNotNull())
        return known.groupBy("cohort_day").agg(F.count(F.lit(1)).alias("user_count"))
    if null_policy == "keep_null_day":
        return first_days.groupBy("cohort_day").agg(F.count("user_id").alias("user_count"))
    raise ValueError(f"unknown null policy: {null_policy}")
