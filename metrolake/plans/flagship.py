"""Flagship query: price per distance by weather condition, with the deviation
from the overall mean (C28 + D29-D31)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metrolake import constants as K
from metrolake.operators import serve as D
from metrolake.operators import weather as W
from metrolake.sources import surrogates as S


def weather_deviation(spark: SparkSession, sf_dir: str, years=None) -> DataFrame:
    hw = W.hourly_weather(S.trips_e(spark, sf_dir), S.weather_e(spark, sf_dir))
    return D.deviation_one_pass(hw, "condition", K.CONDITIONS, years)
