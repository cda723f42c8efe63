"""Registered serving queries (D1-D33) and brief questions.

Each query rebuilds the marts it serves from the surrogate views (so it reads
the whole tables), then applies the serving operator. The filter state is
the full selection except for D1/D2, whose filter *is* the operator.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from metrolake import constants as K
from metrolake import oracle as O
from metrolake.operators import marts as M
from metrolake.operators import questions as Q
from metrolake.operators import serve as D
from metrolake.operators import weather as W
from metrolake.plans import gold
from metrolake.plans.catalog import (C5_SELECT, DO, HEAT, HIST, HV, HZ, JV, JZ, L_SUR, L_WIDTH, LINKS_SQL, NODES_SQL, PPK,
                                     PPKB, PU, RESTRICTED, TIMELINE, TIPS, TOPZ, WDIM, ZONE1, ZS, MEAN_COURSES, mean_gate,
                                     _ratio_sql, register, te, tl, we)
from metrolake.sources import surrogates as S

SEL_YEARS = [1996, 1997, 1998, 1999]
EVENT_YEARS = [2023, 2024]
SEL_VEHICLES = ["green", "yellow"]
ALL_VEHICLES = ["fhv", "green", "yellow"]


def _in(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


# ------------------------------------------------------------------ marts as SQL CTEs
LINKS = f"links AS ({LINKS_SQL})"
NODES = f"nodes AS ({NODES_SQL})"
DENSE = ("dense AS (SELECT annee, zone, CAST("
         + O.half_up_div("CAST(sum(CAST(prix_km_moyen AS DECIMAL(18,2)) * courses) * 100 AS HUGEINT)",
                         "sum(courses)")
         + " AS DOUBLE) / 100 AS prix_km_moyen, CAST(sum(courses) AS BIGINT) AS courses, ["
         + ", ".join(f"CAST(sum(CASE WHEN bin = {i} THEN courses ELSE 0 END) AS BIGINT)" for i in range(K.NBINS))
         + "] AS hist FROM hist GROUP BY annee, zone)")
HIST_CTES = [PPK, PPKB, TOPZ, RESTRICTED, HIST, DENSE]
GRID = ("grid AS (SELECT g.annee, g.vehicle_type, d.jour, h.heure, COALESCE(heat.courses, 0) AS n "
        "FROM (SELECT DISTINCT annee, vehicle_type FROM heat) g "
        "CROSS JOIN (SELECT CAST(range AS INT) AS jour FROM range(7)) d "
        "CROSS JOIN (SELECT CAST(range AS INT) AS heure FROM range(24)) h "
        "LEFT JOIN heat USING (annee, vehicle_type, jour, heure))")
COND = "cond AS (" + _ratio_sql("annee, condition", "(SELECT *, year AS annee FROM jv) b") + ")"
TBAND = ("tband AS (" + _ratio_sql("annee, bande", "(SELECT *, year AS annee, "
         f"{O.temperature_band_sql('temperature')} AS bande FROM jv) b") + ")")
GLOB = "globr AS (" + _ratio_sql("annee", "(SELECT *, year AS annee FROM jv) b") + ")"
HOURR = "hourr AS (" + _ratio_sql("annee, condition, heure", "(SELECT *, year AS annee FROM jv) b") + ")"
RAINR = f"rainr AS (SELECT *, {O.ratio('pluie', 'clair', 4)} AS ratio FROM rain)"


def _rain_ctes(gate: str) -> list[str]:
    """Zone x condition groups that reach the gate, and each zone's rain and clear price."""
    rain, clear = f"condition = '{K.RAIN_CONDITION}'", f"condition = '{K.CLEAR_CONDITION}'"
    return [ZONE1, f"zoner AS (SELECT * FROM zone1 WHERE courses >= {gate})",
            f"rain AS (SELECT zone, max(CASE WHEN {rain} AND courses >= {gate} THEN prix_km_moyen END) AS pluie, "
            f"max(CASE WHEN {clear} AND courses >= {gate} THEN prix_km_moyen END) AS clair, "
            f"CAST(COALESCE(max(CASE WHEN {rain} THEN courses END), 0) AS BIGINT) AS pluie_n "
            f"FROM zoner WHERE {rain} OR {clear} GROUP BY zone)", RAINR]


DIST = ("dist AS (" + _ratio_sql("annee, bande", f"(SELECT year AS annee, {O.distance_band_sql('trip_distance')} "
        "AS bande, 1 AS courses, total_amount AS somme_total, trip_distance AS somme_km FROM trips_e "
        "WHERE trip_distance > 0 AND total_amount IS NOT NULL) b", " HAVING sum(somme_km) <> 0") + ")")
ZAGG = ("zagg AS (SELECT zone, CAST(sum(pickups) AS BIGINT) AS pickups, CAST(sum(dropoffs) AS BIGINT) AS dropoffs, "
        f"{O.weighted_mean('tarif_moyen', 'pickups')} AS tarif, {O.weighted_mean('prix_km_moyen', 'pickups')} "
        "AS prix_km FROM zs GROUP BY zone)")
ZS_CTES = [PU, DO, ZS, ZAGG]
WEATHER_V = ["trips_e", "weather_e"]


SUR = f"sur AS ({C5_SELECT})"


# ------------------------------------------------------------------ Spark-side mart builders
def _timeline(spark, d):
    return M.monthly_timeline(tl(spark, d))


def _zone_agg(spark, d, years=None, vehicles=None):
    return D.zone_aggregate(M.zone_stats(tl(spark, d)), years, vehicles)


def _hw(spark, d):
    return W.hourly_weather(te(spark, d), we(spark, d))


def _hwz(spark, d):
    return W.hourly_weather(te(spark, d), we(spark, d), by="pulocation_id")


def _rain_clear(spark, d, mean: bool = False):
    """Rain and clear prices behind the fixed gate, or behind the mean trip count of all groups."""
    hwz = _hwz(spark, d)
    gate = mean_gate(W.price_by_zone_condition(hwz, 1)) if mean else K.RAIN_GATE
    return D.zone_rain_clear(W.price_by_zone_condition(hwz, gate), gate)


def _rain(spark, d, mean: bool = False):
    return D.rain_ratio(_rain_clear(spark, d, mean))


def _links_nodes(spark, d):
    """Links and nodes from one rollup of the flows, so the trips are scanned once."""
    flows = gold.Rollups(tl(spark, d))
    return flows.od_top_links(), flows.od_top_nodes()


def _dense(spark, d):
    return M.price_histogram_dense(M.price_histogram(tl(spark, d), L_WIDTH))


def _heat_long(spark, d):
    return D.heatmap_long(M.heatmap_dense(M.heatmap_counts(te(spark, d))))


# ------------------------------------------------------------------ D1-D5
@register("D1_cross_filter", O.with_views(["trips_l"], TIMELINE) +
          f"SELECT * FROM tline WHERE annee IN ({_in(SEL_YEARS)}) AND vehicle IN ({_in(SEL_VEHICLES)})")
def q_d1(spark, d):
    return D.cross_filter(_timeline(spark, d), SEL_YEARS, SEL_VEHICLES)


def _mm(expr):
    return f"lpad(CAST(({expr}) % 100 AS VARCHAR), 2, '0') || '/' || CAST(({expr}) // 100 AS VARCHAR)"


@register("D2_filtered_kpis", O.with_views(["trips_l"], TIMELINE) +
          "SELECT CAST(COALESCE(sum(courses), 0) AS BIGINT) AS courses, "
          f"{_mm('min(annee * 100 + mois)')} AS debut, {_mm('max(annee * 100 + mois)')} AS fin, "
          "(SELECT string_agg(CAST(annee AS VARCHAR), ', ' ORDER BY annee) FROM (SELECT DISTINCT annee FROM tline "
          f"WHERE annee IN ({_in(SEL_YEARS)}))) AS annees, "
          "(SELECT string_agg(vehicle, ', ' ORDER BY vehicle) FROM (SELECT DISTINCT vehicle FROM tline "
          f"WHERE vehicle IN ({_in(SEL_VEHICLES)}))) AS vehicules "
          f"FROM tline WHERE annee IN ({_in(SEL_YEARS)}) AND vehicle IN ({_in(SEL_VEHICLES)})")
def q_d2(spark, d):
    return D.filtered_kpis(_timeline(spark, d), SEL_YEARS, SEL_VEHICLES)


@register("D3_share_by_vehicle", O.with_views(["trips_l"], TIMELINE) +
          "SELECT vehicle, CAST(c AS BIGINT) AS courses, "
          f"{O.ratio('c', 'sum(c) OVER ()', 2, 100.0)} AS part_pct "
          "FROM (SELECT vehicle, sum(courses) AS c FROM tline GROUP BY vehicle) v")
def q_d3(spark, d):
    return D.share_by_vehicle(_timeline(spark, d))


@register("D3_trips_by_year", O.with_views(["trips_l"], TIMELINE) +
          "SELECT annee, CAST(sum(courses) AS BIGINT) AS courses FROM tline GROUP BY annee")
def q_d3b(spark, d):
    return D.trips_by_year(_timeline(spark, d))


@register("D4_month_vehicle_pivot", O.with_views(["trips_l"], TIMELINE) +
          "SELECT annee, mois, " + ", ".join(
              f"CAST(COALESCE(sum(courses) FILTER (WHERE vehicle = '{v}'), 0) AS BIGINT) AS {v}"
              for v in ALL_VEHICLES) +
          f" FROM tline WHERE vehicle IN ({_in(ALL_VEHICLES)}) GROUP BY annee, mois")
def q_d4(spark, d):
    return D.month_vehicle_pivot(_timeline(spark, d), ALL_VEHICLES)


@register("D5_peak_month", O.with_views(["trips_l"], TIMELINE) +
          "SELECT * FROM tline ORDER BY courses DESC, annee, mois, vehicle LIMIT 1")
def q_d5(spark, d):
    return D.peak_month(_timeline(spark, d))


# ------------------------------------------------------------------ D6-D12
@register("D6_zone_aggregate", O.with_views(["trips_l"], *ZS_CTES) + "SELECT * FROM zagg")
def q_d6(spark, d):
    return _zone_agg(spark, d)


WZ_CTES = [WDIM, HZ, JZ, *_rain_ctes(str(K.RAIN_GATE))]
WZ_MEAN_CTES = [WDIM, HZ, JZ, *_rain_ctes(MEAN_COURSES)]


@register("D7_zone_rain_clear", O.with_views(WEATHER_V, *WZ_CTES) + "SELECT zone, pluie, clair, pluie_n FROM rain")
def q_d7(spark, d):
    return _rain_clear(spark, d)


@register("D7_zone_rain_clear_mean", O.with_views(WEATHER_V, *WZ_MEAN_CTES) + "SELECT zone, pluie, clair, pluie_n FROM rain")
def q_d7_mean(spark, d):
    return _rain_clear(spark, d, mean=True)


@register("D8_rain_ratio", O.with_views(WEATHER_V, *WZ_CTES) + "SELECT * FROM rainr")
def q_d8(spark, d):
    return _rain(spark, d)


@register("D8_rain_ratio_mean", O.with_views(WEATHER_V, *WZ_MEAN_CTES) + "SELECT * FROM rainr")
def q_d8_mean(spark, d):
    return _rain(spark, d, mean=True)


def _metric_sql(metric, weather_ctes=WZ_CTES):
    if metric in ("pluie", "ratio_pluie"):
        col = "pluie" if metric == "pluie" else "ratio"
        body = (f"SELECT zagg.zone, CAST(rainr.{col} AS DOUBLE) AS value FROM zagg "
                "LEFT JOIN rainr ON zagg.zone = rainr.zone")
    else:
        body = f"SELECT zone, CAST({metric} AS DOUBLE) AS value FROM zagg"
    return (O.with_views(["trips_l", "trips_e", "weather_e"], *ZS_CTES, *weather_ctes)
            + f"SELECT * FROM ({body}) m WHERE value > 0")


def _metric_query(metric, mean=False):
    def q(spark, d):
        rain = _rain(spark, d, mean) if metric in ("pluie", "ratio_pluie") else None      # the others need no weather
        return D.zone_metric(_zone_agg(spark, d), rain, metric)
    return q


for _m in D.METRICS:
    register(f"D9_zone_metric_{_m}", _metric_sql(_m))(_metric_query(_m))
for _m in ("pluie", "ratio_pluie"):
    register(f"D9_zone_metric_{_m}_mean", _metric_sql(_m, WZ_MEAN_CTES))(_metric_query(_m, mean=True))


@register("D10_top_zones", O.with_views(["trips_l"], *ZS_CTES) +
          "SELECT * FROM zagg ORDER BY pickups DESC, zone LIMIT 12")
def q_d10(spark, d):
    return D.top_zones(_zone_agg(spark, d), 12)


@register("D11_zone_detail", O.with_views(["trips_l"], *ZS_CTES) +
          "SELECT * FROM zagg WHERE zone = (SELECT zone FROM zagg ORDER BY pickups DESC, zone LIMIT 1)")
def q_d11(spark, d):
    za = _zone_agg(spark, d)
    return D.zone_detail(za, D.top_zones(za, 1).select("zone"))


@register("D12_links_touching_zone", O.with_views(["trips_l", "zones_s"], LINKS, NODES) +
          "SELECT * FROM links WHERE source IN (SELECT location_id FROM zones_s) "
          "AND target IN (SELECT location_id FROM zones_s) AND ((SELECT id FROM nodes ORDER BY pickups DESC, id "
          "LIMIT 1) IN (source, target))")
def q_d12(spark, d):
    links, nodes = _links_nodes(spark, d)
    focus = nodes.orderBy(F.desc("pickups"), "id").limit(1).select("id")
    return D.links_touching(links, S.zones_s(spark, d), focus)


# ------------------------------------------------------------------ D13-D14
def _long_sur_sql(metric):
    parts = [f"SELECT vehicle_type, '{s}' AS surcharge, annee, {s}_{metric} AS value FROM sur" for s in L_SUR]
    return "(" + " UNION ALL ".join(parts) + ")"


@register("D13_surcharge_series", O.with_views(["trips_l"], SUR) +
          "SELECT vehicle_type, surcharge, annee, value FROM (SELECT *, count(value) OVER "
          f"(PARTITION BY vehicle_type, surcharge) AS n FROM {_long_sur_sql('moyen')} l) s WHERE n > 0")
def q_d13(spark, d):
    return D.surcharge_series(M.surcharge_evolution(tl(spark, d), L_SUR), L_SUR, "moyen")


@register("D13_surcharge_series_total", O.with_views(["trips_l"], SUR) +
          "SELECT vehicle_type, surcharge, annee, value FROM (SELECT *, count(value) OVER "
          f"(PARTITION BY vehicle_type, surcharge) AS n FROM {_long_sur_sql('total')} l) s WHERE n > 0")
def q_d13b(spark, d):
    return D.surcharge_series(M.surcharge_evolution(tl(spark, d), L_SUR), L_SUR, "total")


@register("D14_surcharges_present", O.with_views(["trips_l"], SUR) +
          f"SELECT surcharge FROM {_long_sur_sql('moyen')} l GROUP BY surcharge HAVING count(value) > 0")
def q_d14(spark, d):
    return D.surcharges_present(M.surcharge_evolution(tl(spark, d), L_SUR), L_SUR)


# ------------------------------------------------------------------ D15-D18
BETWEEN = ("lbn AS (SELECT * FROM links WHERE source IN (SELECT id FROM nodes) "
           "AND target IN (SELECT id FROM nodes))")


@register("D15_links_between_nodes", O.with_views(["trips_l"], LINKS, NODES, BETWEEN) + "SELECT * FROM lbn")
def q_d15(spark, d):
    links, nodes = _links_nodes(spark, d)
    return D.links_between_nodes(links, nodes)


@register("D16_node_scale", O.with_views(["trips_l"], NODES) +
          f"SELECT id, pickups, {O.ratio('pickups', 'max(pickups) OVER ()', 4)} AS echelle FROM nodes")
def q_d16(spark, d):
    return D.scale_to_max(M.od_top_nodes(tl(spark, d)), "pickups")


@register("D16_link_scale", O.with_views(["trips_l"], LINKS, NODES, BETWEEN) +
          f"SELECT source, target, count, {O.ratio('count', 'max(count) OVER ()', 4)} AS echelle FROM lbn")
def q_d16b(spark, d):
    links, nodes = _links_nodes(spark, d)
    return D.scale_to_max(D.links_between_nodes(links, nodes), "count")


@register("D17_od_matrix", O.with_views(["trips_l"], LINKS, NODES) +
          "SELECT * FROM links WHERE count > 0 AND source IN (SELECT id FROM nodes ORDER BY pickups DESC, id LIMIT 15) "
          "AND target IN (SELECT id FROM nodes ORDER BY pickups DESC, id LIMIT 15)")
def q_d17(spark, d):
    links, nodes = _links_nodes(spark, d)
    return D.od_matrix(links, nodes, 15)


@register("D18_top_departures", O.with_views(["trips_l"], NODES) +
          "SELECT * FROM nodes ORDER BY pickups DESC, id LIMIT 12")
def q_d18(spark, d):
    return D.top_departures(M.od_top_nodes(tl(spark, d)), 12)


@register("D18_dominant_axis", O.with_views(["trips_l"], LINKS, NODES, BETWEEN) +
          "SELECT * FROM lbn ORDER BY count DESC, source, target LIMIT 1")
def q_d18b(spark, d):
    links, nodes = _links_nodes(spark, d)
    return D.dominant_axis(links, nodes)


# ------------------------------------------------------------------ D19-D22
@register("D19_ridge_heights", O.with_views(["trips_l"], *HIST_CTES) +
          "SELECT zone, annee, bin, n, "
          f"{O.ratio('n', 'greatest(max(n) OVER (PARTITION BY zone), 1)', 4)} AS hauteur FROM "
          f"(SELECT zone, annee, CAST(unnest(range({K.NBINS})) AS INT) AS bin, unnest(hist) AS n FROM dense) s")
def q_d19(spark, d):
    return D.ridge_heights(_dense(spark, d))


@register("D20_last_year_price", O.with_views(["trips_l"], *HIST_CTES) +
          f"SELECT zone, annee, {O.weighted_mean('prix_km_moyen', 'courses')} AS prix_km_moyen FROM "
          "(SELECT *, max(annee) OVER (PARTITION BY zone) AS last FROM dense) s WHERE annee = last GROUP BY zone, annee")
def q_d20(spark, d):
    return D.last_year_price(_dense(spark, d))


CMP = ("cmp AS (SELECT zone, annee, prix_km_moyen FROM dense WHERE courses > 0 AND zone IN "
       "(SELECT DISTINCT zone FROM dense WHERE courses > 0 ORDER BY zone LIMIT 6))")


@register("D21_zone_comparator", O.with_views(["trips_l"], *HIST_CTES, CMP) + "SELECT * FROM cmp")
def q_d21(spark, d):
    return D.zone_comparator(_dense(spark, d))


def _wide_sql(row: str, col: str, value: str, source: str, values) -> str:
    """One column per listed value, as the tables of the studied dashboard have them."""
    cells = ", ".join(f"max(CASE WHEN {col} = {v} THEN {value} END) AS \"{v}\"" for v in values)
    return f"SELECT {row}, {cells} FROM {source} GROUP BY {row}"


@register("D21_zone_comparator_wide", O.with_views(["trips_l"], *HIST_CTES, CMP) +
          _wide_sql("zone", "annee", "prix_km_moyen", "cmp", SEL_YEARS))
def q_d21_wide(spark, d):
    return D.pivot_table(D.zone_comparator(_dense(spark, d)), "zone", "annee", "prix_km_moyen", SEL_YEARS)


@register("D22_cheapest_zone_year", O.with_views(["trips_l"], *HIST_CTES, CMP) +
          "SELECT * FROM cmp ORDER BY prix_km_moyen, annee, zone LIMIT 1")
def q_d22(spark, d):
    return D.cheapest(D.zone_comparator(_dense(spark, d)))


# ------------------------------------------------------------------ D23-D25
@register("D23_heatmap_long", O.with_views(["trips_e"], HEAT, GRID) +
          "SELECT annee, vehicle_type, heure, jour, n FROM grid")
def q_d23(spark, d):
    return _heat_long(spark, d)


@register("D24_busiest_slot", O.with_views(["trips_e"], HEAT, GRID) +
          "SELECT annee, vehicle_type, jour, heure, n FROM (SELECT *, row_number() OVER (PARTITION BY annee, "
          "vehicle_type ORDER BY n DESC, jour, heure) AS rk FROM grid) s WHERE rk = 1")
def q_d24(spark, d):
    return D.busiest_slot(_heat_long(spark, d))


PROFILE = ("prof AS (SELECT annee, vehicle_type, heure, CAST(sum(n) AS BIGINT) AS n FROM grid "
           "GROUP BY annee, vehicle_type, heure)")


@register("D25_hourly_profile", O.with_views(["trips_e"], HEAT, GRID, PROFILE) + "SELECT * FROM prof")
def q_d25(spark, d):
    return D.hourly_profile(_heat_long(spark, d))


@register("D25_profile_peak", O.with_views(["trips_e"], HEAT, GRID, PROFILE) +
          "SELECT annee, vehicle_type, heure, n FROM (SELECT *, row_number() OVER (PARTITION BY annee "
          "ORDER BY n DESC, vehicle_type, heure) AS rk FROM prof) s WHERE rk = 1")
def q_d25b(spark, d):
    return D.profile_peak(D.hourly_profile(_heat_long(spark, d)))


# ------------------------------------------------------------------ D26-D28
_BANDS = "[" + ", ".join(f"'{b}'" for b in K.DISTANCE_BANDS) + "]"


@register("D26_distance_series", O.with_views(["trips_e"], DIST) +
          f"SELECT CAST(list_position({_BANDS}, bande) AS INT) AS rang, bande, annee, prix_km_moyen FROM dist")
def q_d26(spark, d):
    return D.distance_series(M.price_by_distance(te(spark, d)))


@register("D26_distance_series_wide", O.with_views(["trips_e"], DIST) + "SELECT bande, " + ", ".join(
    f"max(CASE WHEN annee = {y} THEN prix_km_moyen END) AS \"{y}\"" for y in EVENT_YEARS) + " FROM dist GROUP BY bande")
def q_d26_wide(spark, d):
    return D.pivot_table(D.distance_series(M.price_by_distance(te(spark, d))), "bande", "annee", "prix_km_moyen", EVENT_YEARS)


def _wm_when(band):
    return O.weighted_mean(f"(CASE WHEN bande = '{band}' THEN prix_km_moyen END)", "courses")


@register("D27_short_long_ratio", O.with_views(["trips_e"], DIST) +
          f"SELECT court, long, {O.ratio('court', 'long', 4)} AS ratio FROM "
          f"(SELECT {_wm_when(K.SHORT_BAND)} AS court, {_wm_when(K.LONG_BAND)} AS long FROM dist) s")
def q_d27(spark, d):
    return D.short_long_ratio(M.price_by_distance(te(spark, d)))


@register("D28_tip_series", O.with_views(["trips_l"], TIPS) + "SELECT vehicle, annee, taux_pct FROM tips")
def q_d28(spark, d):
    return D.tip_series(M.tip_rates(tl(spark, d)))


@register("D28_tip_series_wide", O.with_views(["trips_l"], TIPS) + _wide_sql("vehicle", "annee", "taux_pct", "tips", SEL_YEARS))
def q_d28_wide(spark, d):
    return D.pivot_table(D.tip_series(M.tip_rates(tl(spark, d))), "vehicle", "annee", "taux_pct", SEL_YEARS)


# ------------------------------------------------------------------ D29-D33
WV_CTES = [WDIM, HV, JV, COND, TBAND, GLOB, HOURR]


def _wby_sql(src, dim):
    return (f"SELECT {dim}, {O.weighted_mean('prix_km_moyen', 'courses')} AS prix_km_moyen, "
            f"CAST(sum(courses) AS BIGINT) AS courses FROM {src} GROUP BY {dim}")


BYC = "byc AS (" + _wby_sql("cond", "condition") + ")"
OVERALL = f"ovr AS (SELECT {O.weighted_mean('prix_km_moyen', 'courses')} AS moyenne FROM globr)"


@register("D29_by_condition", O.with_views(WEATHER_V, *WV_CTES) + _wby_sql("cond", "condition"))
def q_d29(spark, d):
    return D.weighted_by(W.price_by_condition(_hw(spark, d)), "condition")


@register("D29_by_temperature_band", O.with_views(WEATHER_V, *WV_CTES) + _wby_sql("tband", "bande"))
def q_d29b(spark, d):
    return D.weighted_by(W.price_by_temperature(_hw(spark, d)), "bande")


@register("D30_overall_mean", O.with_views(WEATHER_V, *WV_CTES, OVERALL) + "SELECT * FROM ovr")
def q_d30(spark, d):
    return D.overall_mean(W.price_by_year(_hw(spark, d)))


_CONDS = "[" + ", ".join(f"'{c}'" for c in K.CONDITIONS) + "]"


@register("D31_deviation", O.with_views(WEATHER_V, *WV_CTES, BYC, OVERALL) +
          f"SELECT CAST(list_position({_CONDS}, condition) AS INT) AS rang, condition, prix_km_moyen, courses, "
          f"CASE WHEN moyenne <> 0 THEN {O.sround('((prix_km_moyen - moyenne) / moyenne) * 100.0', 2)} END "
          "AS ecart_pct, prix_km_moyen >= moyenne AS au_dessus FROM byc CROSS JOIN ovr "
          f"WHERE list_position({_CONDS}, condition) > 0")
def q_d31(spark, d):
    from metrolake.plans.flagship import weather_deviation
    return weather_deviation(spark, d)


@register("D32_condition_hour_matrix", O.with_views(WEATHER_V, *WV_CTES) +
          f"SELECT * FROM (SELECT condition, heure, {O.weighted_mean('prix_km_moyen', 'courses', 2)} AS prix_km_moyen "
          "FROM hourr GROUP BY condition, heure) s WHERE prix_km_moyen IS NOT NULL")
def q_d32(spark, d):
    return D.condition_hour_matrix(W.price_by_condition_hour(_hw(spark, d)))


@register("D33_extremes", O.with_views(WEATHER_V, *WV_CTES, BYC, OVERALL) +
          "SELECT hi.condition AS plus_chere, hi.prix_km_moyen AS prix_plus_chere, "
          f"{O.sround('((hi.prix_km_moyen - moyenne) / moyenne) * 100.0', 1)} AS ecart_pct, "
          "lo.condition AS moins_chere, lo.prix_km_moyen AS prix_moins_chere FROM "
          "(SELECT * FROM byc ORDER BY prix_km_moyen DESC, condition DESC LIMIT 1) hi, "
          "(SELECT * FROM byc ORDER BY prix_km_moyen, condition LIMIT 1) lo, ovr")
def q_d33(spark, d):
    hw = _hw(spark, d)
    return D.extremes(D.weighted_by(W.price_by_condition(hw), "condition"),
                      D.overall_mean(W.price_by_year(hw)))


# ------------------------------------------------------------------ E2-E3
@register("E2_most_frequent_pickup_zone", O.with_views(["trips_l", "zones_s"]) +
          "SELECT p.zone, p.pickups, COALESCE(z.zone, 'Zone ' || CAST(p.zone AS VARCHAR)) AS zone_name, "
          "COALESCE(z.borough, '') AS borough FROM (SELECT pulocation_id AS zone, CAST(count(*) AS BIGINT) AS pickups "
          "FROM trips_l WHERE pulocation_id IS NOT NULL GROUP BY 1 ORDER BY pickups DESC, zone LIMIT 1) p "
          "LEFT JOIN zones_s z ON p.zone = z.location_id")
def q_e2(spark, d):
    return Q.most_frequent_pickup_zone(tl(spark, d), S.zones_s(spark, d))


@register("E3_weather_at_trip", O.with_views(WEATHER_V) +
          "SELECT t.trip_id, t.pickup_ts, w.temperature, w.weather_code, "
          f"CASE WHEN w.ts IS NULL THEN NULL ELSE {O.condition_sql('w.weather_code')} END AS condition "
          "FROM trips_e t LEFT JOIN weather_e w ON date_trunc('hour', t.pickup_ts) = w.ts")
def q_e3(spark, d):
    return Q.weather_at_trip(te(spark, d), we(spark, d)).select(
        "trip_id", "pickup_ts", "temperature", "weather_code", "condition")
