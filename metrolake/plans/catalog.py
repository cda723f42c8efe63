"""Registered queries: one per operator of the inventory, each paired with the
DuckDB SQL that must give the same rows (None = rows-only check).

Every query reads the benchmark tables in ``sf_dir`` through the surrogate
views, so its work grows with them. Array-valued mart columns are returned as
JSON text (the form the mart sink writes) so both engines compare as strings.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake import constants as K
from metrolake import oracle as O
from metrolake.functions import expressions as X
from metrolake.operators import marts as M
from metrolake.operators import weather as W
from metrolake.sources import surrogates as S

QueryFn = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[QueryFn, str | None]] = {}

L_SUR = S.TRIPS_L_SURCHARGES
L_WIDTH = S.TRIPS_L_BIN_WIDTH
ZONE_WEATHER_MIN = K.MIN_ZONE_WEATHER_TRIPS
MEAN_COURSES = "(SELECT ceil(avg(courses)) FROM zone1)"     # a threshold that parts the groups at every size of the data


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        CATALOG[name] = (fn, sql)
        return fn
    return deco


def tl(spark, d):
    return S.trips_l(spark, d)


def te(spark, d):
    return S.trips_e(spark, d)


def we(spark, d):
    return S.weather_e(spark, d)


def _dbl(*cols):
    return [F.col(c).cast("double").alias(c) for c in cols]


# ----------------------------------------------------------------------------- C1-C4
@register("C1_kpi_total", O.with_views(["trips_l"]) +
          "SELECT CAST(count(*) AS BIGINT) AS total_courses FROM trips_l")
def q_c1(spark, d):
    return M.kpi_total(tl(spark, d))


@register("C2_kpi_period", O.with_views(["trips_l"]) +
          "SELECT strftime(min(pickup_ts), '%d/%m/%Y') AS debut, "
          "strftime(max(pickup_ts), '%d/%m/%Y') AS fin FROM trips_l")
def q_c2(spark, d):
    return M.kpi_period(tl(spark, d))


@register("C3_kpi_by_year", O.with_views(["trips_l"]) +
          "SELECT year AS annee, CAST(count(*) AS BIGINT) AS courses FROM trips_l GROUP BY year")
def q_c3(spark, d):
    return M.kpi_by_year(tl(spark, d))


@register("C4_kpi_by_vehicle", O.with_views(["trips_l"]) +
          "SELECT vehicle_type, CAST(count(*) AS BIGINT) AS courses FROM trips_l GROUP BY vehicle_type")
def q_c4(spark, d):
    return M.kpi_by_vehicle(tl(spark, d))


# ----------------------------------------------------------------------------- C5
def _c5_select():
    cols = []
    for s in L_SUR:
        cols.append(f"{O.avg_exact(s, O.SCALES[s])} AS {s}_moyen")
        cols.append(f"{O.sum_round(s)} AS {s}_total")
    return ("SELECT year AS annee, vehicle_type, " + ", ".join(cols)
            + " FROM trips_l GROUP BY year, vehicle_type")


C5_SELECT = _c5_select()
C5_SQL = O.with_views(["trips_l"]) + C5_SELECT


@register("C5_surcharge_evolution", C5_SQL)
def q_c5(spark, d):
    return M.surcharge_evolution(tl(spark, d), L_SUR)


# ----------------------------------------------------------------------------- C6-C8
ZONED = "pulocation_id IS NOT NULL AND dolocation_id IS NOT NULL"


@register("C6_zoned_counts", O.with_views(["trips_l"]) +
          f"SELECT CAST(count(*) FILTER (WHERE {ZONED}) AS BIGINT) AS courses_zonees, "
          f"CAST(count(*) - count(*) FILTER (WHERE {ZONED}) AS BIGINT) AS courses_non_zonees FROM trips_l")
def q_c6(spark, d):
    return M.zoned_counts(tl(spark, d))


LINKS_SQL = (f"SELECT pulocation_id AS source, dolocation_id AS target, CAST(count(*) AS BIGINT) AS count "
             f"FROM trips_l WHERE {ZONED} GROUP BY 1, 2 ORDER BY count DESC, source, target LIMIT {K.TOP_LINKS}")
NODES_SQL = (f"SELECT pulocation_id AS id, CAST(count(*) AS BIGINT) AS pickups "
             f"FROM trips_l WHERE {ZONED} GROUP BY 1 ORDER BY pickups DESC, id LIMIT {K.TOP_ZONES}")


@register("C7_od_top_links", O.with_views(["trips_l"]) + LINKS_SQL)
def q_c7(spark, d):
    return M.od_top_links(tl(spark, d))


@register("C8_od_top_nodes", O.with_views(["trips_l"]) + NODES_SQL)
def q_c8(spark, d):
    return M.od_top_nodes(tl(spark, d))


# ----------------------------------------------------------------------------- C9-C14
PPK = ("ppk AS (SELECT year, pulocation_id, "
       f"{O.ddiv('total_amount', 'trip_distance')} AS prix_km FROM trips_l "
       "WHERE trip_distance > 0 AND pulocation_id IS NOT NULL AND total_amount IS NOT NULL)")
PPKB = (f"ppkb AS (SELECT *, CAST(greatest(least(floor(prix_km / {L_WIDTH}), {K.NBINS - 1}), 0) AS INT) AS bin "
        "FROM ppk)")
TOPZ = (f"topz AS (SELECT pulocation_id FROM ppk GROUP BY 1 "
        f"ORDER BY count(*) DESC, pulocation_id LIMIT {K.TOP_ZONES})")
RESTRICTED = "ppkr AS (SELECT * FROM ppkb WHERE pulocation_id IN (SELECT pulocation_id FROM topz))"
HIST = ("hist AS (SELECT year AS annee, pulocation_id AS zone, bin, CAST(count(*) AS BIGINT) AS courses, "
        f"{O.sround('avg(prix_km)')} AS prix_km_moyen FROM ppkr GROUP BY 1, 2, 3)")


def _price_rows(spark, d):
    return M.price_rows(tl(spark, d))


@register("C9_price_rows", O.with_views(["trips_l"], PPK) +
          "SELECT year AS annee, pulocation_id AS zone, prix_km FROM ppk")
def q_c9(spark, d):
    return _price_rows(spark, d).select(F.col("year").alias("annee"),
                                        F.col("pulocation_id").alias("zone"), "prix_km")


@register("C10_price_bin", O.with_views(["trips_l"], PPK, PPKB) +
          "SELECT year AS annee, pulocation_id AS zone, prix_km, bin FROM ppkb")
def q_c10(spark, d):
    return (M.with_price_bin(_price_rows(spark, d), L_WIDTH)
             .select(F.col("year").alias("annee"), F.col("pulocation_id").alias("zone"), "prix_km", "bin"))


@register("C11_top_zone_restriction", O.with_views(["trips_l"], PPK, PPKB, TOPZ, RESTRICTED) +
          "SELECT year AS annee, pulocation_id AS zone, prix_km, bin FROM ppkr")
def q_c11(spark, d):
    r = M.restrict_to_top_zones(M.with_price_bin(_price_rows(spark, d), L_WIDTH))
    return r.select(F.col("year").alias("annee"), F.col("pulocation_id").alias("zone"), "prix_km", "bin")


HIST_SQL = O.with_views(["trips_l"], PPK, PPKB, TOPZ, RESTRICTED, HIST)


@register("C12_price_histogram", HIST_SQL + "SELECT * FROM hist")
def q_c12(spark, d):
    return M.price_histogram(tl(spark, d), L_WIDTH)


def _dense_hist_sql():
    slots = ", ".join(f"CAST(sum(CASE WHEN bin = {i} THEN courses ELSE 0 END) AS BIGINT)"
                      for i in range(K.NBINS))
    w = "CAST(sum(CAST(prix_km_moyen AS DECIMAL(18,2)) * courses) * 100 AS HUGEINT)"
    return (HIST_SQL + f"SELECT annee, zone, CAST({O.half_up_div(w, 'sum(courses)')} AS DOUBLE) / 100 "
            f"AS prix_km_moyen, CAST(sum(courses) AS BIGINT) AS courses, CAST(to_json([{slots}]) AS VARCHAR) AS hist "
            "FROM hist GROUP BY annee, zone")


@register("C13_price_histogram_dense", _dense_hist_sql())
def q_c13(spark, d):
    dense = M.price_histogram_dense(M.price_histogram(tl(spark, d), L_WIDTH))
    return dense.withColumn("hist", F.to_json("hist"))


def _labels_sql():
    labels = ", ".join(f"'{int(i * L_WIDTH)}-{int((i + 1) * L_WIDTH)}$'" for i in range(K.NBINS))
    return (O.with_views(["trips_l"], PPK, TOPZ) +
            f"SELECT CAST(to_json([{labels}]) AS VARCHAR) AS bins, "
            "(SELECT CAST(to_json(list(pulocation_id ORDER BY pulocation_id)) AS VARCHAR) FROM topz) AS zones")


@register("C14_bin_labels", _labels_sql())
def q_c14(spark, d):
    out = M.price_bin_labels(tl(spark, d), L_WIDTH)
    return out.select(F.to_json("bins").alias("bins"), F.to_json("zones").alias("zones"))


# ----------------------------------------------------------------------------- C15-C16
HEAT = ("heat AS (SELECT year AS annee, vehicle_type, CAST(isodow(pickup_ts) - 1 AS INT) AS jour, "
        "CAST(hour(pickup_ts) AS INT) AS heure, CAST(count(*) AS BIGINT) AS courses "
        "FROM trips_e GROUP BY 1, 2, 3, 4)")


@register("C15_heatmap_counts", O.with_views(["trips_e"], HEAT) + "SELECT * FROM heat")
def q_c15(spark, d):
    return M.heatmap_counts(te(spark, d))


def _heat_dense_sql():
    rows = []
    for dd in range(7):
        cells = ", ".join(f"CAST(sum(CASE WHEN jour = {dd} AND heure = {h} THEN courses ELSE 0 END) AS BIGINT)"
                          for h in range(24))
        rows.append(f"[{cells}]")
    return (O.with_views(["trips_e"], HEAT) +
            f"SELECT annee, vehicle_type, CAST(to_json([{', '.join(rows)}]) AS VARCHAR) AS matrice FROM heat GROUP BY 1, 2")


@register("C16_heatmap_dense", _heat_dense_sql())
def q_c16(spark, d):
    return (M.heatmap_dense(M.heatmap_counts(te(spark, d)))
             .select("annee", "vehicle_type", F.to_json("matrice").alias("matrice")))


# ----------------------------------------------------------------------------- C17-C21
COND_PK = (f"CASE WHEN trip_distance > 0 AND total_amount IS NOT NULL "
           f"THEN {O.ddiv('total_amount', 'trip_distance')} END")
PU = ("pu AS (SELECT pulocation_id AS zone, year AS annee, vehicle_type AS vehicle, "
      f"CAST(count(*) AS BIGINT) AS pickups, {O.avg_exact('fare_amount', 2)} AS tarif_moyen, "
      f"{O.sround(f'avg({COND_PK})')} AS prix_km_moyen "
      "FROM trips_l WHERE pulocation_id IS NOT NULL GROUP BY 1, 2, 3)")
DO = ("dof AS (SELECT dolocation_id AS zone, year AS annee, vehicle_type AS vehicle, "
      "CAST(count(*) AS BIGINT) AS dropoffs FROM trips_l WHERE dolocation_id IS NOT NULL GROUP BY 1, 2, 3)")
ZS = ("zs AS (SELECT pu.zone, pu.annee, pu.vehicle, pu.pickups, COALESCE(dof.dropoffs, 0) AS dropoffs, "
      "pu.tarif_moyen, pu.prix_km_moyen FROM pu LEFT JOIN dof ON pu.zone = dof.zone "
      "AND pu.annee = dof.annee AND pu.vehicle = dof.vehicle)")
ZS_SQL = O.with_views(["trips_l"], PU, DO, ZS)


@register("C17_zone_pickups", O.with_views(["trips_l"], PU) + "SELECT * FROM pu")
def q_c17(spark, d):
    return M.zone_pickups(tl(spark, d))


@register("C18_conditional_average", O.with_views(["trips_l"], PU) +
          "SELECT zone, annee, vehicle, prix_km_moyen FROM pu")
def q_c18(spark, d):
    return M.zone_conditional_price(tl(spark, d))


@register("C19_zone_dropoffs", O.with_views(["trips_l"], DO) + "SELECT * FROM dof")
def q_c19(spark, d):
    return M.zone_dropoffs(tl(spark, d))


@register("C20_zone_stats", ZS_SQL + "SELECT * FROM zs")
def q_c20(spark, d):
    return M.zone_stats(tl(spark, d))


TIMELINE = ("tline AS (SELECT year AS annee, month AS mois, vehicle_type AS vehicle, "
            "CAST(count(*) AS BIGINT) AS courses FROM trips_l GROUP BY 1, 2, 3)")


@register("C21_monthly_timeline", O.with_views(["trips_l"], TIMELINE) + "SELECT * FROM tline")
def q_c21(spark, d):
    return M.monthly_timeline(tl(spark, d))


@register("E1_trips_per_vehicle_month", O.with_views(["trips_l"], TIMELINE) + "SELECT * FROM tline")
def q_e1(spark, d):
    return M.monthly_timeline(tl(spark, d))


# ----------------------------------------------------------------------------- C22-C31
WDIM = ("wdim AS (SELECT ts, temperature, weather_code, CAST(year(ts) AS INT) AS year, "
        "CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS jour, CAST(hour(ts) AS INT) AS heure, "
        f"{O.condition_sql('weather_code')} AS condition FROM weather_e)")


def _hourly(by: str) -> str:
    extra = " AND pulocation_id IS NOT NULL" if by == "pulocation_id" else ""
    name = "hz" if by == "pulocation_id" else "hv"
    return (f"{name} AS (SELECT year, month, CAST(day(pickup_ts) AS INT) AS jour, "
            f"CAST(hour(pickup_ts) AS INT) AS heure, {by}, CAST(count(*) AS BIGINT) AS courses, "
            "sum(total_amount) AS somme_total, sum(trip_distance) AS somme_km FROM trips_e "
            f"WHERE trip_distance > 0 AND total_amount IS NOT NULL{extra} GROUP BY 1, 2, 3, 4, 5)")


HV, HZ = _hourly("vehicle_type"), _hourly("pulocation_id")
JV = ("jv AS (SELECT hv.*, wdim.ts, wdim.temperature, wdim.weather_code, wdim.condition, "
      f"{O.ddiv('somme_total', 'somme_km')} AS prix_km FROM hv JOIN wdim USING (year, month, jour, heure))")
JZ = ("jz AS (SELECT hz.*, wdim.temperature, wdim.weather_code, wdim.condition "
      "FROM hz JOIN wdim USING (year, month, jour, heure))")
WV_SQL = O.with_views(["trips_e", "weather_e"], WDIM, HV, JV)
WZ_SQL = O.with_views(["trips_e", "weather_e"], WDIM, HZ, JZ)


def _wv(spark, d):
    return W.hourly_weather(te(spark, d), we(spark, d))


def _wz(spark, d):
    return W.hourly_weather(te(spark, d), we(spark, d), by="pulocation_id")


def _ratio_sql(keys: str, src: str, having: str = "") -> str:
    return (f"SELECT {keys}, CAST(sum(courses) AS BIGINT) AS courses, "
            f"{O.ratio('sum(somme_total)', 'sum(somme_km)')} AS prix_km_moyen FROM {src} "
            f"GROUP BY {keys}{having}")


@register("C22_weather_condition", O.with_views(["weather_e"]) +
          f"SELECT ts, weather_code, {O.condition_sql('weather_code')} AS condition FROM weather_e")
def q_c22(spark, d):
    return we(spark, d).select("ts", "weather_code", X.weather_condition("weather_code").alias("condition"))


@register("C23_weather_time_keys", O.with_views(["weather_e"], WDIM) +
          "SELECT ts, year, month, jour, heure FROM wdim")
def q_c23(spark, d):
    return W.weather_dim(we(spark, d)).select("ts", "year", "month", "jour", "heure")


@register("C24_hourly_rollup", O.with_views(["trips_e"], HV) +
          "SELECT year, month, jour, heure, vehicle_type, courses, CAST(somme_total AS DOUBLE) AS somme_total, "
          "CAST(somme_km AS DOUBLE) AS somme_km FROM hv")
def q_c24(spark, d):
    return W.hourly_rollup(te(spark, d)).select("year", "month", "jour", "heure", "vehicle_type", "courses",
                                                *_dbl("somme_total", "somme_km"))


@register("C25_hourly_weather_join", WV_SQL +
          "SELECT year, month, jour, heure, vehicle_type, courses, temperature, weather_code, condition, "
          "prix_km FROM jv")
def q_c25(spark, d):
    return _wv(spark, d).select("year", "month", "jour", "heure", "vehicle_type", "courses",
                                "temperature", "weather_code", "condition", "prix_km")


@register("C26_hourly_zone_weather", WZ_SQL +
          "SELECT year, month, jour, heure, pulocation_id, courses, CAST(somme_total AS DOUBLE) AS somme_total, "
          "CAST(somme_km AS DOUBLE) AS somme_km, condition FROM jz")
def q_c26(spark, d):
    return _wz(spark, d).select("year", "month", "jour", "heure", "pulocation_id", "courses",
                                *_dbl("somme_total", "somme_km"), "condition")


@register("C27_temperature_band", O.with_views(["weather_e"]) +
          f"SELECT ts, temperature, {O.temperature_band_sql('temperature')} AS bande FROM weather_e")
def q_c27(spark, d):
    return we(spark, d).select("ts", "temperature", X.temperature_band("temperature").alias("bande"))


@register("C28_price_by_condition", WV_SQL +
          _ratio_sql("annee, condition", "(SELECT *, year AS annee FROM jv) b"))
def q_c28(spark, d):
    return W.price_by_condition(_wv(spark, d))


@register("C28_price_by_temperature_band", WV_SQL +
          _ratio_sql("annee, bande", f"(SELECT *, year AS annee, {O.temperature_band_sql('temperature')} AS bande "
                                     "FROM jv) b"))
def q_c28b(spark, d):
    return W.price_by_temperature(_wv(spark, d))


@register("C29_price_by_year", WV_SQL + _ratio_sql("annee", "(SELECT *, year AS annee FROM jv) b"))
def q_c29(spark, d):
    return W.price_by_year(_wv(spark, d))


@register("C30_price_by_condition_hour", WV_SQL +
          _ratio_sql("annee, condition, heure", "(SELECT *, year AS annee FROM jv) b"))
def q_c30(spark, d):
    return W.price_by_condition_hour(_wv(spark, d))


@register("C31_price_by_zone_condition", WZ_SQL +
          _ratio_sql("zone, condition", "(SELECT *, pulocation_id AS zone FROM jz) b",
                     f" HAVING sum(courses) >= {ZONE_WEATHER_MIN}"))
def q_c31(spark, d):
    return W.price_by_zone_condition(_wz(spark, d), ZONE_WEATHER_MIN)


ZONE1 = "zone1 AS (" + _ratio_sql("zone, condition", "(SELECT *, pulocation_id AS zone FROM jz) b") + ")"


def mean_gate(zone_condition: DataFrame):
    """The mean trip count of all groups, rounded up, as a scalar."""
    return zone_condition.agg(F.ceil(F.avg("courses"))).scalar()


@register("C31_price_by_zone_condition_mean", O.with_views(["trips_e", "weather_e"], WDIM, HZ, JZ, ZONE1) +
          f"SELECT * FROM zone1 WHERE courses >= {MEAN_COURSES}")
def q_c31_mean(spark, d):
    hwz = _wz(spark, d)
    return W.price_by_zone_condition(hwz, mean_gate(W.price_by_zone_condition(hwz, 1)))


# ----------------------------------------------------------------------------- C32-C34
@register("C32_price_by_distance", O.with_views(["trips_e"]) +
          _ratio_sql("annee, bande", f"(SELECT year AS annee, {O.distance_band_sql('trip_distance')} AS bande, "
                                     "1 AS courses, total_amount AS somme_total, trip_distance AS somme_km "
                                     "FROM trips_e WHERE trip_distance > 0 AND total_amount IS NOT NULL) b",
                     " HAVING sum(somme_km) <> 0"))
def q_c32(spark, d):
    return M.price_by_distance(te(spark, d))


TIPS = ("tips AS (SELECT year AS annee, vehicle_type AS vehicle, CAST(count(*) AS BIGINT) AS courses, "
        f"{O.ratio('sum(tip_amount)', 'sum(fare_amount)', scale=100.0)} AS taux_pct, "
        f"{O.avg_exact('tip_amount', 4)} AS pourboire_moyen FROM trips_l "
        "WHERE tip_amount IS NOT NULL AND fare_amount > 0 GROUP BY 1, 2)")


@register("C33_tip_rates", O.with_views(["trips_l"], TIPS) + "SELECT * FROM tips")
def q_c33(spark, d):
    return M.tip_rates(tl(spark, d))


ZONE_NAMED = ("SELECT p.zone, p.pickups, COALESCE(z.zone, 'Zone ' || CAST(p.zone AS VARCHAR)) AS zone_name, "
              "COALESCE(z.borough, '') AS borough FROM (SELECT pulocation_id AS zone, CAST(count(*) AS BIGINT) "
              "AS pickups FROM trips_l WHERE pulocation_id IS NOT NULL GROUP BY 1) p "
              "LEFT JOIN zones_s z ON p.zone = z.location_id")


@register("C34_zone_naming", O.with_views(["trips_l", "zones_s"]) + ZONE_NAMED)
def q_c34(spark, d):
    t = tl(spark, d).filter(F.col("pulocation_id").isNotNull())
    p = t.groupBy(F.col("pulocation_id").alias("zone")).agg(F.count(F.lit(1)).alias("pickups"))
    return M.name_zones(p, S.zones_s(spark, d))
