"""Registered marts computed through the shared rollups (R1-R3), the path the
gold run takes. Each query builds the rollups of the surrogate trips (written
under ``spark.checkpoint.dir``) and derives one mart from them; the oracle is
the same SQL as the direct form, so the gate checks rollup = direct."""
from __future__ import annotations

from metrolake import constants as K
from metrolake.plans import gold
from metrolake.plans.catalog import CATALOG, L_WIDTH, ZONE_WEATHER_MIN, register, te, tl, we
from metrolake.sources import surrogates as S


def _rl(spark, d):
    return gold.Rollups(tl(spark, d), S.TRIPS_L_SURCHARGES, L_WIDTH, K.NBINS)


def _re(spark, d):
    return gold.Rollups(te(spark, d), [], 1.0, K.NBINS)


def _sql(name):
    return CATALOG[name][1]


@register("R1_C5_surcharge_evolution", _sql("C5_surcharge_evolution"))
def q_r_c5(spark, d):
    return _rl(spark, d).surcharge_evolution()


@register("R1_R2_C20_zone_stats", _sql("C20_zone_stats"))
def q_r_c20(spark, d):
    return _rl(spark, d).zone_stats()


@register("R1_C21_monthly_timeline", _sql("C21_monthly_timeline"))
def q_r_c21(spark, d):
    return _rl(spark, d).monthly_timeline()


@register("R1_C33_tip_rates", _sql("C33_tip_rates"))
def q_r_c33(spark, d):
    return _rl(spark, d).tip_rates()


@register("R2_C7_od_top_links", _sql("C7_od_top_links"))
def q_r_c7(spark, d):
    return _rl(spark, d).od_top_links()


@register("R3_C12_price_histogram", _sql("C12_price_histogram"))
def q_r_c12(spark, d):
    return _rl(spark, d).price_histogram()


@register("R3_C32_price_by_distance", _sql("C32_price_by_distance"))
def q_r_c32(spark, d):
    return _re(spark, d).price_by_distance()


@register("R1_C15_heatmap_counts", _sql("C15_heatmap_counts"))
def q_r_c15(spark, d):
    return _re(spark, d).heatmap_counts()


@register("R1_C28_price_by_condition", _sql("C28_price_by_condition"))
def q_r_c28(spark, d):
    return _re(spark, d).weather_marts(we(spark, d), ZONE_WEATHER_MIN)["rows"]


@register("R1_C31_price_by_zone_condition", _sql("C31_price_by_zone_condition"))
def q_r_c31(spark, d):
    return _re(spark, d).weather_marts(we(spark, d), ZONE_WEATHER_MIN)["zone_rows"]
