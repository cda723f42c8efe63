"""Rollup form = direct form and physical-plan checks (test 4)."""
import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from metrolake.plans.catalog import CATALOG
from metrolake import constants as K
from metrolake.operators import marts as M
from metrolake.operators import questions as Q
from metrolake.operators import weather as W
from metrolake.plans import gold
from metrolake.sources import lake as L
from metrolake.sources import surrogates as S
from tests.conftest import SF_SMALL
from tests.oracle_util import rows


def _same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert rows([r.asDict() for r in a.collect()], cols) == rows([r.asDict() for r in b.collect()], cols)


@pytest.fixture(scope="module")
def rolled(spark):
    trips = S.trips_l(spark, SF_SMALL)
    return trips, gold.Rollups(trips, S.TRIPS_L_SURCHARGES, S.TRIPS_L_BIN_WIDTH, K.NBINS)


@pytest.mark.parametrize("mart", ["kpi_total", "kpi_period", "kpi_by_year", "kpi_by_vehicle", "zoned_counts",
                                  "od_top_links", "od_top_nodes", "zone_dropoffs", "zone_pickups", "zone_stats",
                                  "monthly_timeline", "price_by_distance", "tip_rates", "heatmap_counts"])
def test_rollup_equals_direct(rolled, mart):
    trips, r = rolled
    _same(getattr(r, mart)(), getattr(M, mart)(trips))


def test_rollup_surcharges_and_histogram(rolled):
    trips, r = rolled
    _same(r.surcharge_evolution(), M.surcharge_evolution(trips, S.TRIPS_L_SURCHARGES))
    _same(r.price_histogram(), M.price_histogram(trips, S.TRIPS_L_BIN_WIDTH))


def test_rollup_weather_equals_direct(spark):
    trips, weather = S.trips_e(spark, SF_SMALL), S.weather_e(spark, SF_SMALL)
    r = gold.Rollups(trips, [], 1.0, K.NBINS)
    _same(r.weather_marts(weather)["rows"], W.price_by_condition(W.hourly_weather(trips, weather)))


def test_gold_run_writes_every_mart(spark, workdir):
    trips, weather = S.trips_e(spark, SF_SMALL), S.weather_e(spark, SF_SMALL)
    marts = gold.run(spark, trips, weather, f"{workdir}/gold", surcharges=[], dataset_id="events")
    for name in marts:
        assert spark.read.json(f"{workdir}/gold/events/{name}").count() == marts[name].count()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_registered_plan(spark):
    for name, (fn, _sql) in CATALOG.items():
        if name.startswith(("A1_", "A2_", "A5_", "A8_", "A9_", "A20_late", "A24_", "A25_", "R1_", "R2_", "R3_")):
            continue                      # these write files (or rollup tables) when called
        p = fn(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_weather_joins_are_broadcast(spark):
    trips, weather = S.trips_e(spark, SF_SMALL), S.weather_e(spark, SF_SMALL)
    assert "BroadcastHashJoin" in _plan(W.hourly_weather(trips, weather))
    assert "BroadcastHashJoin" in _plan(Q.weather_at_trip(trips, weather))


def test_silver_scan_pushes_filters_and_prunes_partitions(spark, workdir):
    trips = S.trips_l(spark, SF_SMALL).select(*[c for c in S.trips_l(spark, SF_SMALL).columns])
    base = f"{workdir}/silver"
    L.write_silver_trips(trips.withColumn("trip_distance", trips.trip_distance.cast("double"))
                              .withColumn("total_amount", trips.total_amount.cast("double")), base)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    silver = L.read_silver_trips(spark, base).filter("year = 1997")
    p = _plan(M.price_rows(silver).select("year", "prix_km"))
    assert "PartitionFilters: [isnotnull(year" in p and "(year" in p and "= 1997)" in p
    pushed = p.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("IsNotNull(trip_distance)", "IsNotNull(pulocation_id)", "IsNotNull(total_amount)",
              "GreaterThan(trip_distance,0.0)"):
        assert f in pushed
    schema = p.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert sorted(schema.split(",")) == ["pulocation_id:int", "total_amount:double", "trip_distance:double"]


def test_fused_deviation_equals_composed_operators(spark):
    from metrolake.operators import serve as D
    trips, weather = S.trips_e(spark, "/root/testdata/sf0.01"), S.weather_e(spark, "/root/testdata/sf0.01")
    hw = W.hourly_weather(trips, weather)
    composed = D.deviation(D.weighted_by(W.price_by_condition(hw), "condition"),
                           D.overall_mean(W.price_by_year(hw)), "condition", K.CONDITIONS)
    _same(D.deviation_one_pass(hw), composed)
    assert _plan(D.deviation_one_pass(hw)).count("Scan parquet") == 2       # events: trips + weather hours
