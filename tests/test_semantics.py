"""Labels, bands, bins, dense shapes, naming and top-k rules on small frames."""
import datetime as dt

from pyspark.sql import functions as F

from metrolake import constants as K
from metrolake.functions import expressions as X
from metrolake.operators import marts as M


def test_weather_condition_boundaries(spark):
    codes = [None, 0, 1, 3, 4, 48, 49, 69, 70, 79, 80, 82, 83, 94, 95, -1]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    got = {r.c: r.l for r in df.select("c", X.weather_condition("c").alias("l")).collect()}
    assert got[None] == "Inconnu" and got[0] == "Dégagé" and got[-1] == "Nuageux"
    assert (got[1], got[3], got[4], got[48]) == ("Nuageux", "Nuageux", "Brouillard", "Brouillard")
    assert (got[49], got[69], got[70], got[79]) == ("Pluie", "Pluie", "Neige", "Neige")
    assert (got[80], got[82], got[83], got[94], got[95]) == ("Averses", "Averses", "Neige", "Neige", "Orage")


def test_temperature_bands_null_goes_top(spark):
    temps = [-0.1, 0.0, 9.9, 10.0, 20.0, 30.0, None]
    df = spark.createDataFrame([(t,) for t in temps], "t double")
    got = [r.b for r in df.select(X.temperature_band("t").alias("b")).collect()]
    assert got == ["< 0°C", "0-10°C", "0-10°C", "10-20°C", "20-30°C", "≥ 30°C", "≥ 30°C"]


def test_price_bin_clamps(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (0.99,), (1.0,), (8.99,), (9.0,), (250.0,)], "p double")
    assert [r.b for r in df.select(X.price_bin("p").alias("b")).collect()] == [0, 0, 0, 1, 8, 9, 9]


def test_dense_heatmap_is_7x24_and_zero_filled(spark):
    t = spark.createDataFrame([(2024, "yellow", dt.datetime(2024, 1, 1, 5, 0)),   # Monday 05h
                               (2024, "yellow", dt.datetime(2024, 1, 7, 23, 0))],  # Sunday 23h
                              "year int, vehicle_type string, pickup_ts timestamp_ntz")
    r = M.heatmap_dense(M.heatmap_counts(t)).first()
    assert len(r.matrice) == 7 and all(len(row) == 24 for row in r.matrice)
    assert r.matrice[0][5] == 1 and r.matrice[6][23] == 1 and sum(map(sum, r.matrice)) == 2
    assert r.jours == K.DAY_LABELS and r.heures == list(range(24))


def test_zone_stats_left_join_semantics(spark):
    t = spark.createDataFrame([(2020, "green", 1, 2, 10.0, 2.0, 12.0), (2020, "green", 1, None, 20.0, 0.0, 5.0),
                               (2020, "green", None, 3, 8.0, 1.0, 9.0)],
                              "year int, vehicle_type string, pulocation_id int, dolocation_id int, "
                              "fare_amount double, trip_distance double, total_amount double")
    rows = {r.zone: r for r in M.zone_stats(t).collect()}
    assert set(rows) == {1}                             # zones 2 and 3 have dropoffs only: gone
    assert rows[1].pickups == 2 and rows[1].dropoffs == 0 and rows[1].tarif_moyen == 15.0
    assert rows[1].prix_km_moyen == 6.0                 # only the trip with distance > 0
    full = {r.zone for r in M.zone_stats(t, keep_dropoff_only=True).collect()}
    assert full == {1, 2, 3}


def test_top_links_tie_break_and_self_loops(spark):
    t = spark.createDataFrame([(5, 5), (5, 5), (2, 3), (1, 4)], "pulocation_id int, dolocation_id int")
    links = [(r["source"], r["target"], r["count"]) for r in M.od_top_links(t, 2).collect()]
    assert links == [(5, 5, 2), (1, 4, 1)]


def test_zone_naming_fallback(spark):
    df = spark.createDataFrame([(1,), (7,)], "zone int")
    zones = spark.createDataFrame([(1, "JFK Airport", "Queens")], "location_id int, zone string, borough string")
    got = {r.zone: (r.zone_name, r.borough) for r in M.name_zones(df, zones).collect()}
    assert got == {1: ("JFK Airport", "Queens"), 7: ("Zone 7", "")}


def test_surcharge_null_is_not_zero(spark):
    t = spark.createDataFrame([(2010, "yellow", None, 0.5), (2010, "yellow", None, 0.0)],
                              "year int, vehicle_type string, extra double, mta_tax double")
    r = M.surcharge_evolution(t, ["extra", "mta_tax"]).first()
    assert r.extra_moyen is None and r.extra_total is None
    assert r.mta_tax_moyen == 0.25 and r.mta_tax_total == 0.5


def test_serving_weighted_means_skip_null_rows(spark):
    from metrolake.operators import serve as D
    zs = spark.createDataFrame([(1, 2020, "yellow", 10, 5, 12.5, None), (1, 2021, "yellow", 30, 0, 10.0, 4.0)],
                               "zone int, annee int, vehicle string, pickups long, dropoffs long, "
                               "tarif_moyen double, prix_km_moyen double")
    r = D.zone_aggregate(zs).first()
    assert (r.pickups, r.dropoffs) == (40, 5)
    assert r.tarif == 10.625 and r.prix_km == 4.0      # NULL row out of the price weights


def test_busiest_slot_ties_take_first_day_hour(spark):
    from metrolake.operators import serve as D
    long = spark.createDataFrame([(2024, "y", 5, 2, 7), (2024, "y", 3, 4, 7), (2024, "y", 1, 4, 7)],
                                 "annee int, vehicle_type string, heure int, jour int, n long")
    r = D.busiest_slot(long).first()
    assert (r.jour, r.heure, r.n) == (2, 5, 7)


def test_deviation_fixed_order_drops_unknown(spark):
    from metrolake.operators import serve as D
    by = spark.createDataFrame([("Pluie", 3.0, 10), ("Inconnu", 9.0, 1), ("Dégagé", 2.0, 10)],
                               "condition string, prix_km_moyen double, courses long")
    overall = spark.createDataFrame([(2.5,)], "moyenne double")
    rows = D.deviation(by, overall, "condition", K.CONDITIONS).collect()
    assert [r.condition for r in rows] == ["Dégagé", "Pluie"]
    assert [r.ecart_pct for r in rows] == [-20.0, 20.0] and [r.au_dessus for r in rows] == [False, True]


def test_pivot_table_wide_form(spark):
    from metrolake.operators import serve as D
    long = spark.createDataFrame([(1, "0-1 km", 2019, 5.5), (1, "0-1 km", 2020, 6.0), (6, "20+ km", 2020, 2.0)],
                                 "rang int, bande string, annee int, prix_km_moyen double")
    wide = D.pivot_table(long, ["rang", "bande"], "annee", "prix_km_moyen", values=[2019, 2020]).collect()
    assert [tuple(r) for r in wide] == [(1, "0-1 km", 5.5, 6.0), (6, "20+ km", None, 2.0)]
