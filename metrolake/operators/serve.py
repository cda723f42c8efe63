"""Serving operators over the marts: cross-filters, re-aggregations, rankings
and ratios, as DataFrame functions taking the filter state as parameters
(``years``, ``vehicles``, ``zone``, ``metric``).

Marts are small (bounded by years x vehicles x zones x bins), so these plans
are cheap; they still never collect to the driver: top-k is
``orderBy().limit()``, "the max over all rows" is a window over an empty
partition spec only where the input is a bounded mart, and arg-max picks use
``max(struct(...))`` so ties resolve deterministically.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from metrolake import constants as K
from metrolake.functions import expressions as X
from metrolake.plans.joins import broadcast_bounded

# Largest id list (zone dimension, node list) broadcast without a shuffle join.
MAX_DIMENSION_ROWS = 100_000


def _sel(df: DataFrame, years=None, vehicles=None, year_col="annee", vehicle_col="vehicle") -> DataFrame:
    if years is not None:
        df = df.filter(F.col(year_col).isin(list(years)))
    if vehicles is not None:
        df = df.filter(F.col(vehicle_col).isin(list(vehicles)))
    return df


# --- D1-D5: timeline --------------------------------------------------------------

def cross_filter(mart: DataFrame, years=None, vehicles=None, vehicle_col="vehicle") -> DataFrame:
    """Rows of a mart whose year and vehicle are selected."""
    return _sel(mart, years, vehicles, vehicle_col=vehicle_col)


def _mm_yyyy(key):
    return F.concat(F.lpad((key % 100).cast("string"), 2, "0"), F.lit("/"),
                    F.floor(key / 100).cast("string"))


def filtered_kpis(timeline: DataFrame, years=None, vehicles=None) -> DataFrame:
    """Total trips, first / last month (MM/yyyy), sorted selected years and
    vehicles that exist in the timeline."""
    tl = _sel(timeline, years, vehicles)
    key = F.col("annee") * 100 + F.col("mois")
    stats = tl.agg(F.sum("courses").cast("bigint").alias("courses"),
                   F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    ys = timeline.select("annee").distinct()
    vs = timeline.select("vehicle").distinct()
    if years is not None:
        ys = ys.filter(F.col("annee").isin(list(years)))
    if vehicles is not None:
        vs = vs.filter(F.col("vehicle").isin(list(vehicles)))
    ys = ys.agg(F.array_join(F.transform(F.sort_array(F.collect_list("annee")),
                                         lambda y: y.cast("string")), ", ")).scalar()
    vs = vs.agg(F.array_join(F.sort_array(F.collect_list("vehicle")), ", ")).scalar()
    return stats.select(
        F.coalesce(F.col("courses"), F.lit(0)).cast("bigint").alias("courses"),
        _mm_yyyy(F.col("_lo")).alias("debut"), _mm_yyyy(F.col("_hi")).alias("fin"),
        ys.alias("annees"), vs.alias("vehicules"))


def share_by_vehicle(timeline: DataFrame, years=None, vehicles=None) -> DataFrame:
    """D3: trips per vehicle and percent of the filtered total, descending."""
    by = _sel(timeline, years, vehicles).groupBy("vehicle").agg(F.sum("courses").alias("courses"))
    total = F.sum("courses").over(Window.partitionBy())
    return (by.select("vehicle", F.col("courses").cast("bigint").alias("courses"),
                      X.ratio(F.col("courses"), total, 2, 100.0).alias("part_pct"))
              .orderBy(F.desc("courses"), "vehicle"))


def trips_by_year(timeline: DataFrame, years=None, vehicles=None) -> DataFrame:
    """D3: bars by year."""
    return (_sel(timeline, years, vehicles).groupBy("annee")
            .agg(F.sum("courses").cast("bigint").alias("courses")).orderBy("annee"))


def month_vehicle_pivot(timeline: DataFrame, vehicles, years=None) -> DataFrame:
    """(year, month) x vehicle counts, 0-filled, one column per selected vehicle."""
    vehicles = sorted(vehicles)
    tl = _sel(timeline, years, vehicles)
    return (tl.groupBy("annee", "mois").pivot("vehicle", vehicles).agg(F.sum("courses"))
              .na.fill(0, subset=vehicles).orderBy("annee", "mois"))


def peak_month(timeline: DataFrame, years=None, vehicles=None) -> DataFrame:
    """The (month, vehicle) row with most trips; ties -> earliest row."""
    return (_sel(timeline, years, vehicles)
            .orderBy(F.desc("courses"), "annee", "mois", "vehicle").limit(1))


# --- D6-D12: zones -------------------------------------------------------------------

def zone_aggregate(zone_stats: DataFrame, years=None, vehicles=None) -> DataFrame:
    """Per zone over the selection: pickups, dropoffs, pickup-weighted mean fare
    and price (rows with a NULL mean are left out of that mean's weights)."""
    zs = _sel(zone_stats, years, vehicles)
    return zs.groupBy("zone").agg(
        F.sum("pickups").cast("bigint").alias("pickups"),
        F.sum("dropoffs").cast("bigint").alias("dropoffs"),
        X.weighted_mean("tarif_moyen", "pickups").alias("tarif"),
        X.weighted_mean("prix_km_moyen", "pickups").alias("prix_km"))


def zone_rain_clear(zone_weather: DataFrame, gate: int = K.RAIN_GATE) -> DataFrame:
    """Per zone, the rain and clear prices when their trip counts reach the gate."""
    rain, clear = K.RAIN_CONDITION, K.CLEAR_CONDITION
    zw = zone_weather.filter(F.col("condition").isin(rain, clear))
    ok = F.col("courses") >= gate
    return zw.groupBy("zone").agg(
        F.max(F.when((F.col("condition") == rain) & ok, F.col("prix_km_moyen"))).alias("pluie"),
        F.max(F.when((F.col("condition") == clear) & ok, F.col("prix_km_moyen"))).alias("clair"),
        F.coalesce(F.max(F.when(F.col("condition") == rain, F.col("courses"))), F.lit(0))
         .cast("bigint").alias("pluie_n"))


def rain_ratio(rain_clear: DataFrame) -> DataFrame:
    """Rain / clear price per zone; NULL unless both gates hold."""
    return rain_clear.withColumn("ratio", X.ratio("pluie", "clair", 4))


METRICS = ("pickups", "dropoffs", "tarif", "prix_km", "pluie", "ratio_pluie")


def zone_metric(zone_agg: DataFrame, rain: DataFrame, metric: str = "pickups") -> DataFrame:
    """The selected metric per zone, keeping values > 0."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if metric in ("pluie", "ratio_pluie"):
        col = "pluie" if metric == "pluie" else "ratio"
        j = zone_agg.join(rain.select("zone", F.col(col).alias("value")), "zone", "left")
    else:
        j = zone_agg.select("zone", F.col(metric).cast("double").alias("value"))
    return j.select("zone", F.col("value").cast("double").alias("value")).filter(F.col("value") > 0)


def top_zones(zone_agg: DataFrame, k: int = 12) -> DataFrame:
    """The k zones with most pickups (k = 1: busiest zone)."""
    return zone_agg.orderBy(F.desc("pickups"), "zone").limit(k)


def zone_detail(zone_agg: DataFrame, zone) -> DataFrame:
    """One zone's card; ``zone`` is an id or a one-column frame of ids."""
    if isinstance(zone, DataFrame):
        return zone_agg.join(zone.select(F.col(zone.columns[0]).alias("zone")), "zone", "left_semi")
    return zone_agg.filter(F.col("zone") == zone)


def links_touching(links: DataFrame, zones: DataFrame, focus) -> DataFrame:
    """Links whose both ends are known zones and that touch the focus zone."""
    ids = broadcast_bounded(zones.select(F.col("location_id").alias("_id")), MAX_DIMENSION_ROWS)
    known = (links.join(ids, F.col("source") == F.col("_id"), "left_semi")
                  .join(ids, F.col("target") == F.col("_id"), "left_semi"))
    if isinstance(focus, DataFrame):
        focus = focus.select(F.min(focus.columns[0])).scalar()
    return known.filter((F.col("source") == focus) | (F.col("target") == focus))


# --- D13-D14: surcharges -------------------------------------------------------------

def surcharge_series(surcharge_mart: DataFrame, surcharges=K.SURCHARGES, metric: str = "moyen",
                     years=None, vehicles=None) -> DataFrame:
    """Long (vehicle, surcharge, year, value) series for the mean or total;
    series with no value over the selection are removed, gaps stay NULL."""
    rows = _sel(surcharge_mart, years, vehicles, vehicle_col="vehicle_type")
    stack = F.explode(F.array(*[F.struct(F.lit(s).alias("surcharge"),
                                         F.col(f"{s}_{metric}").alias("value")) for s in surcharges]))
    long = rows.select("vehicle_type", "annee", stack.alias("_s")).select(
        "vehicle_type", "_s.surcharge", "annee", "_s.value")
    n = F.count("value").over(Window.partitionBy("vehicle_type", "surcharge"))
    return long.withColumn("_n", n).filter(F.col("_n") > 0).drop("_n")


def surcharges_present(surcharge_mart: DataFrame, surcharges=K.SURCHARGES) -> DataFrame:
    """Surcharges with at least one non-NULL mean."""
    return surcharge_mart.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("surcharge"), F.col(f"{s}_moyen").alias("v")) for s in surcharges]))
        .alias("_s")).groupBy("_s.surcharge").agg(F.count("_s.v").alias("_n")) \
        .filter(F.col("_n") > 0).select("surcharge")


# --- D15-D18: flows -------------------------------------------------------------------

def links_between_nodes(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links whose both ends are top nodes (``nodes`` is a top-k list, so it may be broadcast)."""
    ids = F.broadcast(nodes.select(F.col("id").alias("_id")))
    return (links.join(ids, F.col("source") == F.col("_id"), "left_semi")
                 .join(ids, F.col("target") == F.col("_id"), "left_semi"))


def scale_to_max(df: DataFrame, value: str, digits: int = 4) -> DataFrame:
    """Value / max(value) over the (bounded) frame."""
    mx = F.max(value).over(Window.partitionBy())
    return df.withColumn("echelle", X.ratio(F.col(value), mx, digits))


def od_matrix(links: DataFrame, nodes: DataFrame, k: int = 15) -> DataFrame:
    """Link counts among the k busiest nodes (long form: origin row, destination column)."""
    top = nodes.orderBy(F.desc("pickups"), "id").limit(k)
    return links_between_nodes(links, top).filter(F.col("count") > 0)


def top_departures(nodes: DataFrame, k: int = 12) -> DataFrame:
    """The k busiest departure zones."""
    return nodes.orderBy(F.desc("pickups"), "id").limit(k)


def dominant_axis(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """The largest link among top nodes."""
    return links_between_nodes(links, nodes).orderBy(F.desc("count"), "source", "target").limit(1)


# --- D19-D22: price histogram ------------------------------------------------------------

def ridge_heights(dense_hist: DataFrame, years=None) -> DataFrame:
    """Each histogram slot over the largest slot of its zone (selected years)."""
    h = _sel(dense_hist, years)
    slots = h.select("zone", "annee", F.posexplode("hist").alias("bin", "n"))
    mx = F.max("n").over(Window.partitionBy("zone"))
    return slots.withColumn("hauteur", X.ratio(F.col("n"), F.greatest(mx, F.lit(1)), 4))


def last_year_price(dense_hist: DataFrame, years=None) -> DataFrame:
    """Per zone, the weighted mean price of its last selected year."""
    h = _sel(dense_hist, years)
    last = h.withColumn("_last", F.max("annee").over(Window.partitionBy("zone"))) \
            .filter(F.col("annee") == F.col("_last"))
    return last.groupBy("zone", "annee").agg(X.weighted_mean("prix_km_moyen", "courses").alias("prix_km_moyen"))


def zone_comparator(dense_hist: DataFrame, zones=None, first_n: int = 6, years=None) -> DataFrame:
    """Zone x year price for a list of zones (default: the first ``first_n`` ids)."""
    h = _sel(dense_hist, years).filter(F.col("courses") > 0)
    if zones is None:
        ids = h.select("zone").distinct().orderBy("zone").limit(first_n)
        h = h.join(F.broadcast(ids), "zone", "left_semi")
    else:
        h = h.filter(F.col("zone").isin(list(zones)))
    return h.select("zone", "annee", "prix_km_moyen")


def cheapest(comparator: DataFrame) -> DataFrame:
    """The cheapest (zone, year); ties -> earliest year, smallest zone."""
    return comparator.orderBy("prix_km_moyen", "annee", "zone").limit(1)


# --- D23-D25: heatmap ---------------------------------------------------------------------

def heatmap_long(dense: DataFrame, year=None, vehicle=None) -> DataFrame:
    """heatmap(year, vehicle) as (hour, day, n) rows."""
    d = dense
    if year is not None:
        d = d.filter(F.col("annee") == year)
    if vehicle is not None:
        d = d.filter(F.col("vehicle_type") == vehicle)
    days = d.select("annee", "vehicle_type", F.posexplode("matrice").alias("jour", "_row"))
    return days.select("annee", "vehicle_type", F.posexplode("_row").alias("heure", "n"), "jour") \
               .select("annee", "vehicle_type", "heure", "jour", "n")


def busiest_slot(long: DataFrame) -> DataFrame:
    """Per (year, vehicle) the (day, hour) with most trips; ties -> first in (day, hour) order."""
    best = F.max(F.struct(F.col("n"), -F.col("jour"), -F.col("heure"))).alias("_b")
    return (long.groupBy("annee", "vehicle_type").agg(best)
                .select("annee", "vehicle_type", (-F.col("_b.col2")).alias("jour"),
                        (-F.col("_b.col3")).alias("heure"), F.col("_b.n").alias("n")))


def hourly_profile(long: DataFrame, vehicles=None) -> DataFrame:
    """Per (year, vehicle, hour) trips summed over the 7 days."""
    l = long if vehicles is None else long.filter(F.col("vehicle_type").isin(list(vehicles)))
    return l.groupBy("annee", "vehicle_type", "heure").agg(F.sum("n").cast("bigint").alias("n"))


def profile_peak(profile: DataFrame) -> DataFrame:
    """Per year the absolute (vehicle, hour) peak; ties -> first vehicle, first hour."""
    w = Window.partitionBy("annee").orderBy(F.desc("n"), "vehicle_type", "heure")
    return (profile.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1)
                   .drop("_rk"))


# --- D26-D28: distance and tips --------------------------------------------------------------

def distance_series(distance_mart: DataFrame, years=None) -> DataFrame:
    """Band x year prices, bands in their fixed rank order (long form;
    ``pivot('annee')`` of this frame gives the band x year table)."""
    ranks = F.array_position(F.array(*[F.lit(b) for b in K.DISTANCE_BANDS]), F.col("bande")).cast("int")
    return _sel(distance_mart, years).select(ranks.alias("rang"), "bande", "annee", "prix_km_moyen")


def short_long_ratio(distance_mart: DataFrame, years=None) -> DataFrame:
    """Weighted mean price of the shortest and the longest band, and their ratio."""
    d = _sel(distance_mart, years)
    out = d.agg(
        X.weighted_mean(F.when(F.col("bande") == K.SHORT_BAND, F.col("prix_km_moyen")), "courses").alias("court"),
        X.weighted_mean(F.when(F.col("bande") == K.LONG_BAND, F.col("prix_km_moyen")), "courses").alias("long"))
    return out.withColumn("ratio", X.ratio("court", "long", 4))


def tip_series(tips: DataFrame, years=None, vehicles=None) -> DataFrame:
    """Tip rate by vehicle x year over the selection (vehicles without rows drop out)."""
    return _sel(tips, years, vehicles).select("vehicle", "annee", "taux_pct")


# --- D29-D33: weather deviation ------------------------------------------------------------------

def weighted_by(rows: DataFrame, dim: str, years=None) -> DataFrame:
    """Per category, trip-weighted mean of the yearly prices, descending."""
    return (_sel(rows, years).groupBy(dim)
            .agg(X.weighted_mean("prix_km_moyen", "courses").alias("prix_km_moyen"),
                 F.sum("courses").cast("bigint").alias("courses"))
            .orderBy(F.desc("prix_km_moyen"), dim))


def overall_mean(global_rows: DataFrame, years=None) -> DataFrame:
    """Trip-weighted mean over all selected years (one row)."""
    return _sel(global_rows, years).agg(X.weighted_mean("prix_km_moyen", "courses").alias("moyenne"))


def deviation(by_category: DataFrame, overall: DataFrame, dim: str, order) -> DataFrame:
    """Deviation from the overall mean in %, above/below flag, fixed order
    (categories missing from ``order``, e.g. the unknown condition, drop out)."""
    cats = F.array(*[F.lit(c) for c in order])
    ranked = by_category.withColumn("rang", F.array_position(cats, F.col(dim)).cast("int")) \
                        .filter(F.col("rang") > 0)
    ranked = ranked.withColumn("moyenne", overall.select("moyenne").scalar())
    dev = F.round((F.col("prix_km_moyen") - F.col("moyenne")) / F.col("moyenne") * F.lit(100.0), 2)
    return (ranked
                  .select("rang", dim, "prix_km_moyen", "courses",
                          F.when(F.col("moyenne") != 0, dev).alias("ecart_pct"),
                          (F.col("prix_km_moyen") >= F.col("moyenne")).alias("au_dessus"))
                  .orderBy("rang"))


def deviation_one_pass(hw: DataFrame, dim: str = "condition", order=K.CONDITIONS, years=None) -> DataFrame:
    """C28 + C29 + D29-D31 fused: the same rows as ``deviation(weighted_by(C28),
    overall_mean(C29))`` from a single pass over the joined hourly rows.

    ``rollup(year, dim)`` yields the (year, dim) sums and the per-year sums in
    one aggregation; the overall mean is a window over that aggregate (years x
    categories rows, bounded), so neither a second scan nor a join is needed."""
    h = hw.withColumnRenamed("year", "annee")
    if years is not None:
        h = h.filter(F.col("annee").isin(list(years)))
    lv = (h.rollup("annee", dim)
           .agg(F.sum("courses").alias("courses"), F.sum("somme_total").alias("_tot"),
                F.sum("somme_km").alias("_km"), F.grouping_id().alias("_g"))
           .filter(F.col("annee").isNotNull() & (F.col("_g") <= 1))
           .withColumn("_p", X.ratio("_tot", "_km")))
    yearly = F.when(F.col("_g") == 1, F.col("_p"))
    lv = lv.withColumn("moyenne", X.weighted_mean(yearly, "courses", over=Window.partitionBy()))
    by = (lv.filter(F.col("_g") == 0).groupBy(dim)
            .agg(X.weighted_mean("_p", "courses").alias("prix_km_moyen"),
                 F.sum("courses").cast("bigint").alias("courses"), F.first("moyenne").alias("moyenne")))
    cats = F.array(*[F.lit(c) for c in order])
    dev = F.round((F.col("prix_km_moyen") - F.col("moyenne")) / F.col("moyenne") * F.lit(100.0), 2)
    return (by.withColumn("rang", F.array_position(cats, F.col(dim)).cast("int")).filter(F.col("rang") > 0)
              .select("rang", dim, "prix_km_moyen", "courses",
                      F.when(F.col("moyenne") != 0, dev).alias("ecart_pct"),
                      (F.col("prix_km_moyen") >= F.col("moyenne")).alias("au_dessus"))
              .orderBy("rang"))


def condition_hour_matrix(hour_rows: DataFrame, years=None) -> DataFrame:
    """(condition, hour) trip-weighted mean price (2 digits) over the selection."""
    return (_sel(hour_rows, years).groupBy("condition", "heure")
            .agg(X.weighted_mean("prix_km_moyen", "courses", 2).alias("prix_km_moyen"))
            .filter(F.col("prix_km_moyen").isNotNull()))


def extremes(by_condition: DataFrame, overall: DataFrame) -> DataFrame:
    """Dearest and cheapest condition, with the dearest one's % deviation."""
    hi = F.max(F.struct("prix_km_moyen", F.lit(0).alias("_"), "condition"))
    lo = F.min(F.struct("prix_km_moyen", F.lit(0).alias("_"), "condition"))
    agg = by_condition.agg(hi.alias("_hi"), lo.alias("_lo")) \
                      .withColumn("moyenne", overall.select("moyenne").scalar())
    return agg.select(
        F.col("_hi.condition").alias("plus_chere"), F.col("_hi.prix_km_moyen").alias("prix_plus_chere"),
        F.round((F.col("_hi.prix_km_moyen") - F.col("moyenne")) / F.col("moyenne") * F.lit(100.0), 1)
         .alias("ecart_pct"),
        F.col("_lo.condition").alias("moins_chere"), F.col("_lo.prix_km_moyen").alias("prix_moins_chere"))


# --- wide views of long serving frames ---------------------------------------------------

def pivot_table(long: DataFrame, row, col: str, value: str, values=None, fill=None) -> DataFrame:
    """Wide form of a long serving frame (D4 month x vehicle, D17 origin x
    destination, D21 year x zone, D26 band x year, D28 vehicle x year): one row
    per ``row`` key, one column per ``col`` value. Pass ``values`` to fix the
    column set (and skip Spark's distinct pass over ``col``); the long frames
    are bounded marts, so the pivot runs on small data."""
    rows = [row] if isinstance(row, str) else list(row)
    p = long.groupBy(*rows).pivot(col, values).agg(F.first(value, ignorenulls=True))
    if fill is not None:
        p = p.na.fill(fill)
    return p.orderBy(*rows)
