"""Rollups refreshed by partition: equal to a full run, and only touched partitions are read and replaced."""
import datetime as dt

import pytest

from metrolake.plans import delta, gold, silver as SV
from metrolake.schemas import TRIP_SCHEMA
from metrolake.sources import lake as L
from metrolake.sources import raw as R

TEMPLATE = "{v}_tripdata_{y}-{m:02d}.parquet"


def _file(spark, folder, vehicle, year, month, start, rows):
    """One raw file of the modern layout, named as the discovery expects it."""
    data = [(1, dt.datetime(year, month, 1 + (start + i) % 27, i % 24), float(i % 9), 1 + (start + i) % 5, 1 + i % 4, 10.0 + i, 2.0, 12.0 + i) for i in range(rows)]
    df = spark.createDataFrame(data, "VendorID int, tpep_pickup_datetime timestamp_ntz, trip_distance double, PULocationID int, DOLocationID int, "
                               "fare_amount double, tip_amount double, total_amount double")
    df.toPandas().astype({"tpep_pickup_datetime": "datetime64[us]"}).to_parquet(f"{folder}/part{start}_{TEMPLATE.format(v=vehicle, y=year, m=month)}")


def _marts(r):
    parts = {"timeline": r.monthly_timeline(), "links": r.od_top_links(), "zones": r.zone_stats(), "distance": r.price_by_distance(),
             "hist": r.price_histogram(), "tips": r.tip_rates(), "heat": r.heatmap_counts(), "total": r.kpi_total()}
    return {n: sorted(map(str, df.collect())) for n, df in parts.items()}


@pytest.fixture
def lake(spark, workdir):
    import os
    raw = f"{workdir}/raw"
    os.makedirs(raw)
    for i, (v, y, m) in enumerate([("yellow", 2020, 1), ("yellow", 2020, 2), ("green", 2020, 1), ("green", 2021, 5)]):
        _file(spark, raw, v, y, m, i, 40)
    silver, stored = f"{workdir}/silver", delta.StoredRollups(spark, f"{workdir}/silver", f"{workdir}/rollups")

    def ingest():
        files = R.discover_files(spark, raw)
        assert SV.build_trips(spark, files, SV.manifest_entries_for(files, "x"), silver).first().ok

    return raw, silver, stored, ingest


def test_refresh_equals_a_full_run_and_replaces_touched_slices_only(spark, lake):
    raw, silver, stored, ingest = lake
    assert stored.kpi_total().first()[0] is None                        # nothing stored yet
    ingest()
    assert stored.refresh() == 4 and stored.refresh() == 0
    before = {n: set(stored._rollup(n).inputFiles()) for n in ("r1", "r2", "r3")}
    _file(spark, raw, "yellow", 2020, 2, 7, 25)                          # a late file, and a month that is new
    _file(spark, raw, "green", 2022, 1, 8, 5)
    ingest()
    spark.catalog.refreshByPath(silver)
    assert stored.refresh() == 2
    full = gold.Rollups(L.read_silver_trips(spark, silver))
    assert _marts(stored) == _marts(full)
    for name, old in before.items():
        now = set(stored._rollup(name).inputFiles())
        part = lambda f: f.split("vehicle_type=")[1].rpartition("/")[0]
        assert {part(f) for f in old - now} == {"yellow/year=2020/month=2"}
        assert {part(f) for f in now - old} == {"yellow/year=2020/month=2", "green/year=2022/month=1"}


def test_refresh_reads_touched_partitions_only(spark, lake):
    raw, silver, stored, ingest = lake
    ingest()
    stored.refresh()
    _file(spark, raw, "green", 2021, 5, 9, 3)
    ingest()
    trips = stored.touched_trips(stored.changed())
    plan = stored._slices(trips)["r2"]._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "concat_ws(" in filters and "= green/" in filters
    assert trips.count() == 43


def test_interrupted_refresh_is_repeated(spark, lake, monkeypatch):
    _raw, silver, stored, ingest = lake
    ingest()
    real = stored._slices
    monkeypatch.setattr(stored, "_slices", lambda t: {**real(t), "r3": t.selectExpr("raise_error('lost')", "vehicle_type", "year", "month")})
    with pytest.raises(Exception, match="lost"):
        stored.refresh()
    monkeypatch.setattr(stored, "_slices", real)
    assert stored.refresh() == 4
    assert _marts(stored) == _marts(gold.Rollups(L.read_silver_trips(spark, silver)))
    assert L.read_silver_trips(spark, silver).schema == TRIP_SCHEMA
