"""Column functions at their edges."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clickmetrics import functions as fn
from fixtures import at


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [(1, 3, 33.33), (2, 3, 66.67), (1, 8, 12.5), (5, 0, None), (0, 5, 0.0), (3, 2, 150.0)],
)
def test_percent(spark, part, whole, expected):
    assert one(spark, fn.percent(F.lit(part), F.lit(whole))) == expected


def test_rounding_is_half_up(spark):
    assert one(spark, fn.money(F.lit(2.675), 2)) == 2.68
    assert one(spark, fn.money(F.lit(0.125), 2)) == 0.13
    assert one(spark, fn.money(F.lit(0.125), None)) == 0.125


def test_safe_divide(spark):
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(4))) == 0.25
    assert one(spark, fn.safe_divide(F.lit(1), F.lit(0))) is None


def test_whole_days_are_24_hours(spark):
    def days(start, end):
        return one(spark, fn.whole_days_between(F.lit(at(start)), F.lit(at(end))))

    assert days("01-01 23:00:00", "01-02 01:00:00") == 0
    assert days("01-01 23:00:00", "01-02 22:59:59") == 0
    assert days("01-01 23:00:00", "01-02 23:00:00") == 1


def test_day_and_hour(spark):
    moment = F.lit(at("01-02 13:45:10"))
    assert one(spark, fn.day_of(moment)) == at("01-02 00:00:00")
    assert one(spark, fn.hour_of(moment)) == at("01-02 13:00:00")
    assert one(spark, fn.day_text(moment)) == "2024-01-02"


def test_event_time_text(spark):
    assert one(spark, fn.to_event_time(F.lit("2024-01-02 13:45:10"))) == at("01-02 13:45:10")
    assert one(spark, fn.to_event_time(F.lit("yesterday"), strict=False)) is None
    with pytest.raises(Exception):
        one(spark, fn.to_event_time(F.lit("yesterday")))
