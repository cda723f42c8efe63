"""Gates that some groups pass and some fail, and weather added month by month."""
import json
import os

from metrolake import constants as K
from metrolake.plans import catalog_gates as G
from metrolake.plans import catalog_serve, silver as SV
from metrolake.sources import lake as L

SF = "/root/testdata/sf0.01"


def test_rain_and_clear_prices_have_values(spark):
    rows = G.q_d8_busy(spark, SF).collect()
    assert len(rows) >= 4 and all(r["pluie"] is not None and r["clair"] is not None and r["ratio"] is not None for r in rows)
    passed = G.q_c31_busy(spark, SF).collect()
    every = G._zone_weather(spark, SF, 1).collect()
    assert 0 < len(passed) < len(every) and min(r["courses"] for r in passed) >= K.MIN_ZONE_WEATHER_TRIPS
    assert {r["value"] for r in G.q_d9_busy(spark, SF).collect()} == {r["ratio"] for r in rows}


def test_flows_scan_the_trips_once(spark):
    links, nodes = catalog_serve._links_nodes(spark, SF)
    for df in (links, nodes):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan and plan.count("FileScan") == 1


def _document(root, year, month, temperature):
    os.makedirs(f"{root}/{year}", exist_ok=True)
    hours = [f"{year}-{month:02d}-01T{h:02d}:00" for h in range(24)]
    body = {"time": hours, "temperature_2m": [temperature] * 24, "precipitation": [0.0] * 24, "snowfall": [0.0] * 24, "weather_code": [3] * 24, "wind_speed_10m": [1.0] * 24}
    with open(f"{root}/{year}/{month:02d}.json", "w") as f:
        json.dump({"hourly": body}, f)


def test_weather_increment_leaves_other_years_alone(spark, workdir):
    root, silver = f"{workdir}/weather", f"{workdir}/silver"
    for year, month in ((2020, 1), (2020, 2), (2021, 3), (2022, 4)):
        _document(root, year, month, float(month))
    months = lambda *m: spark.createDataFrame(list(m), "year int, month int")
    assert SV.add_weather(spark, root, silver, months((2020, 1), (2021, 3))) == 2
    before = {f for f in L.read_silver_weather(spark, silver).inputFiles() if "year=2021" in f}
    assert SV.add_weather(spark, root, silver, months((2020, 1), (2021, 3))) == 0
    assert SV.add_weather(spark, root, silver, months((2020, 2), (1999, 1))) == 1          # no document: not due
    got = L.read_silver_weather(spark, silver)
    assert {(r["year"], r["temperature"]) for r in got.collect()} == {(2020, 1.0), (2020, 2.0), (2021, 3.0)}
    assert got.count() == 72 and before == {f for f in got.inputFiles() if "year=2021" in f}
