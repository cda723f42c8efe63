"""File-level steps on temp-dir fixtures: discovery, fingerprint scans, silver
build with resume, weather documents, zone CSV, streaming re-run."""
import datetime as dt
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from metrolake.operators import manifest as A
from metrolake.plans import silver as SV
from metrolake.sources import lake as L
from metrolake.sources import raw as R
from metrolake.streaming import ingest as STREAM


def _write(path, table):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table, path)


def raw_tree(root):
    ts = [dt.datetime(2016, 7, 1, 8, 0), dt.datetime(2016, 7, 2, 9, 30)]
    modern = pa.table({"VendorID": pa.array([1, 2], pa.int32()), "tpep_pickup_datetime": ts,
                       "tpep_dropoff_datetime": ts, "passenger_count": pa.array([1, 2], pa.int64()),
                       "trip_distance": [1.5, 0.0], "PULocationID": pa.array([132, 138], pa.int32()),
                       "DOLocationID": pa.array([236, 132], pa.int32()), "fare_amount": [7.0, 52.0],
                       "extra": [0.5, 0.0], "tip_amount": [1.0, 0.0], "total_amount": [9.3, 52.8]})
    drifted = pa.table({"VendorID": pa.array([2], pa.int64()), "tpep_pickup_datetime": ts[:1],
                        "tpep_dropoff_datetime": ts[:1], "passenger_count": pa.array([1.0], pa.float64()),
                        "trip_distance": [2.0], "PULocationID": pa.array([1], pa.int32()),
                        "DOLocationID": pa.array([2], pa.int32()), "fare_amount": [9.0], "extra": [1.0],
                        "congestion_surcharge": [0.0], "tip_amount": [0.0], "total_amount": [10.0]})
    legacy = pa.table({"vendor_name": ["VTS", "CMT", "DDS"],
                       "Trip_Pickup_DateTime": ["2009-01-04 02:52:00", "not a date", "2003-01-01 00:00:00"],
                       "Trip_Dropoff_DateTime": ["2009-01-04 03:02:00"] * 3, "Passenger_Count": [1, 1, 1],
                       "Trip_Distance": [2.6, 1.0, 1.0], "Start_Lon": [-73.99, 0.0, 0.0],
                       "Start_Lat": [40.7, 0.0, 0.0], "Fare_Amt": [8.9, 5.0, 5.0], "surcharge": [0.0, 0.5, 0.5],
                       "Tip_Amt": [0.0, 0.0, 0.0], "Total_Amt": [9.4, 5.5, 5.5]})
    _write(f"{root}/2016/07/yellow_tripdata_2016-07.parquet", modern)
    _write(f"{root}/2016/08/yellow_tripdata_2016-08.parquet", drifted)
    _write(f"{root}/2009/01/yellow_tripdata_2009-01.parquet", legacy)
    _write(f"{root}/misc/notes_2016.parquet", modern)
    _write(f"{root}/misc/green_tripdata_2016.parquet", modern)


def test_discovery_skips_non_matching_names(spark, workdir):
    raw_tree(f"{workdir}/raw")
    files = R.discover_files(spark, f"{workdir}/raw")
    got = [(r.vehicle_type, r.year, r.month) for r in files.collect()]
    assert got == [("yellow", 2009, 1), ("yellow", 2016, 7), ("yellow", 2016, 8)]
    assert all(r.size > 0 for r in files.collect())
    assert R.sample_files(files, 2).count() == 2


def test_fingerprint_scan_handles_int_double_drift(spark, workdir):
    raw_tree(f"{workdir}/raw")
    paths = [r.path for r in R.discover_files(spark, f"{workdir}/raw").collect()]
    assert len(R.schema_fingerprints(spark, paths)) == 3
    trips = R.read_raw_trips(spark, paths)
    rows = {(r.vehicle_type, r.year, r.month, r.vendor) for r in trips.collect()}
    assert ("yellow", 2016, 8, "2") in rows and ("yellow", 2009, 1, "VTS") in rows
    c = {r.month: r.congestion_surcharge for r in trips.filter("year = 2016").collect()}
    assert c[8] == 0.0 and c[7] is None


def test_silver_build_resume_and_idempotence(spark, workdir):
    raw_tree(f"{workdir}/raw")
    files = R.discover_files(spark, f"{workdir}/raw")
    entries = SV.manifest_entries_for(files, "city")
    silver = f"{workdir}/silver"
    first = SV.build_trips(spark, files, entries, silver, limit_batches=1).first()   # only (yellow, 2009)
    assert first.ok and first.expected == 1        # garbage and 2003 timestamps fall out of the window
    assert first.pending == 2
    committed = {(r.vehicle_type, r.year, r.month) for r in SV.committed_files(spark, silver).collect()}
    assert committed == {("yellow", 2009, 1)}
    second = SV.build_trips(spark, files, entries, silver).first()                   # resumes with 2016
    assert second.ok and second.expected == 3
    third = SV.build_trips(spark, files, entries, silver).first()                    # nothing left
    assert third.expected == 0
    assert L.read_silver_trips(spark, silver).count() == 4
    pruned = L.read_silver_trips(spark, silver).filter("year = 2016 AND month = 7")
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString() \
        or pruned.count() == 2


def test_committed_batches_ignore_temporary(spark):
    paths = spark.createDataFrame(
        [("s/trips/vehicle_type=yellow/year=2016/month=7/part-0.parquet",),
         ("s/trips/vehicle_type=green/year=2016/_temporary/0/part-0.parquet",),
         ("s/trips/vehicle_type=green/year=2017/month=1/_SUCCESS",)], "path string")
    got = {(r.vehicle_type, r.year) for r in A.committed_batches(paths).collect()}
    assert got == {("yellow", 2016)}


def test_manifest_classify_and_merge(spark):
    schema = "key string, size long, vehicle_type string, year int, month int"
    found = spark.createDataFrame([("a", 1, "yellow", 2016, 1), ("b", 2, "yellow", 2016, 2),
                                   ("c", 3, "green", 2016, 1)], schema)
    manifest = spark.createDataFrame([("a", 1, "yellow", 2016, 1)], schema)
    store = spark.createDataFrame([("a",), ("b",)], "key string")
    st = {r.key: r.status for r in A.classify(found, manifest, store).collect()}
    assert st == {"a": "skipped", "b": "healed", "c": "new"}
    resized = found.withColumn("size", found.size + 1)
    st = {r.key: r.status for r in A.classify(resized, manifest, store, compare_size=True).collect()}
    assert st == {"a": "changed", "b": "healed", "c": "new"}
    merged = A.merge_entries(manifest, found.filter("key != 'a'"))
    assert [r.key for r in merged.collect()] == ["a", "b", "c"]
    s = A.summarize(merged, "city").first()
    assert s.trip_years == [2016] and s.taille_octets == 6 and s.fichiers == 3


def test_weather_documents_uneven_arrays_and_nulls(spark, workdir):
    doc = {"hourly": {"time": ["2016-01-01T00:00", "2016-01-01T01:00", "2016-01-01T02:00"],
                      "temperature_2m": [1.5, None, -2.0], "precipitation": [0.0, 0.1, 0.0],
                      "snowfall": [0.0, 0.0, 0.0], "weather_code": [0, 61, None],
                      "wind_speed_10m": [10.0, 12.0]}}
    os.makedirs(f"{workdir}/weather/2016", exist_ok=True)
    with open(f"{workdir}/weather/2016/01.json", "w") as fh:
        fh.write(json.dumps(doc))
    rows = R.read_weather_json(spark, f"{workdir}/weather").orderBy("ts").collect()
    assert len(rows) == 3 and rows[0].ts == dt.datetime(2016, 1, 1, 0, 0)
    assert rows[1].temperature is None and rows[2].weather_code is None
    assert rows[2].wind_speed is None and all(r.year == 2016 for r in rows)


def test_zone_csv_and_missing_file(spark, workdir):
    p = f"{workdir}/taxi_zone_lookup.csv"
    with open(p, "w") as fh:
        fh.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n')
    r = R.read_zones(spark, p).first()
    assert (r.location_id, r.zone, r.borough) == (1, "Newark Airport", "EWR")
    assert R.read_zones(spark, f"{workdir}/nope.csv").count() == 0


def test_stream_ingest_named_files_second_run_is_empty(spark, workdir):
    raw_tree(f"{workdir}/raw")
    src = f"{workdir}/raw/2016/07"
    schema = spark.read.parquet(src).schema
    args = dict(raw_schema=schema, silver_base=f"{workdir}/silver", checkpoint=f"{workdir}/ckpt",
                window_years=(2016, 2016))
    assert STREAM.ingest(spark, src, **args) == 1
    assert STREAM.ingest(spark, src, **args) == 0
    got = L.read_silver_trips(spark, f"{workdir}/silver").collect()
    assert len(got) == 2 and {(r.vehicle_type, r.year, r.month) for r in got} == {("yellow", 2016, 7)}


def test_interrupted_partition_is_rebuilt(spark, workdir):
    raw_tree(f"{workdir}/raw")
    files = R.discover_files(spark, f"{workdir}/raw")
    entries = SV.manifest_entries_for(files, "city")
    silver = f"{workdir}/silver"
    # a crashed writer left only temporary output for the 2016-07 partition
    os.makedirs(f"{silver}/_temporary/0/vehicle_type=yellow/year=2016/month=7", exist_ok=True)
    _write(f"{silver}/_temporary/0/vehicle_type=yellow/year=2016/month=7/part-0.parquet",
           pa.table({"x": [1]}))
    assert SV.committed_files(spark, silver).count() == 0
    check = SV.build_trips(spark, files, entries, silver).first()
    assert check.ok and check.expected == 4


def test_run_all_end_to_end_and_rerun(spark, workdir):
    from metrolake.plans import lakehouse
    raw_tree(f"{workdir}/raw")
    doc = {"hourly": {"time": ["2016-07-01T08:00", "2016-07-02T09:00"], "temperature_2m": [21.0, 25.0],
                      "precipitation": [0.0, 1.2], "snowfall": [0.0, 0.0], "weather_code": [0, 61],
                      "wind_speed_10m": [3.0, 4.0]}}
    os.makedirs(f"{workdir}/weather/2016", exist_ok=True)
    with open(f"{workdir}/weather/2016/07.json", "w") as fh:
        fh.write(json.dumps(doc))
    with open(f"{workdir}/zones.csv", "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\n132,Queens,JFK Airport,Airports\n")
    out = lakehouse.run_all(spark, f"{workdir}/raw", f"{workdir}/lake", "city",
                            weather_root=f"{workdir}/weather", zones_csv=f"{workdir}/zones.csv")
    assert out["trips_check"].first().ok and out["weather_check"].first().ok
    comp = out["completeness"].first()
    assert comp.dataset_id == "city" and comp.complet, comp.manquants
    assert out["lineage"].first().taille_octets > 0
    cond = {r.condition: r.courses for r in out["mart:weather_deviation/rows"].collect()}
    assert cond == {"Dégagé": 1}            # the 2016-07-01 08:00 trip with distance > 0
    again = lakehouse.run_all(spark, f"{workdir}/raw", f"{workdir}/lake", "city")
    assert again["trips_check"].first().expected == 0        # nothing left to ingest
    assert {r.status: r["count"] for r in out["files_by_status"].collect()} == {"new": 3}
    assert {r.status: r["count"] for r in again["files_by_status"].collect()} == {"skipped": 3}
    runs = spark.read.json(f"{workdir}/lake/manifest")
    assert {r.run for r in runs.collect()} == {1, 2} and runs.count() == 6


def test_strict_month_window_drops_foreign_pickups(spark, workdir):
    raw_tree(f"{workdir}/raw")
    ts = [dt.datetime(2016, 7, 31, 23, 0), dt.datetime(2016, 8, 1, 0, 30)]   # second one is August
    _write(f"{workdir}/raw/2016/07/yellow_tripdata_2016-07.parquet",
           pa.table({"VendorID": pa.array([1, 1], pa.int32()), "tpep_pickup_datetime": ts,
                     "tpep_dropoff_datetime": ts, "trip_distance": [1.0, 1.0], "total_amount": [5.0, 5.0]}))
    files = R.discover_files(spark, f"{workdir}/raw").filter("year = 2016 AND month = 7")
    entries = SV.manifest_entries_for(files, "city")
    loose = SV.build_trips(spark, files, entries, f"{workdir}/s1").first()
    strict = SV.build_trips(spark, files, entries, f"{workdir}/s2", strict_month=True).first()
    assert (loose.expected, strict.expected) == (2, 1)


def test_stream_ingest_picks_up_only_new_files(spark, workdir):
    src = f"{workdir}/incoming"
    ts1, ts2 = [dt.datetime(2016, 7, 1, 8, 0)], [dt.datetime(2016, 8, 3, 9, 0), dt.datetime(2016, 8, 4, 9, 0)]

    def month_file(ts, name):
        _write(f"{src}/{name}", pa.table({"VendorID": pa.array([1] * len(ts), pa.int32()),
                                          "tpep_pickup_datetime": ts, "tpep_dropoff_datetime": ts,
                                          "trip_distance": [1.0] * len(ts), "total_amount": [5.0] * len(ts)}))
    month_file(ts1, "yellow_tripdata_2016-07.parquet")
    schema = spark.read.parquet(src).schema
    args = dict(raw_schema=schema, silver_base=f"{workdir}/silver", checkpoint=f"{workdir}/ckpt",
                window_years=(2016, 2016), max_files_per_trigger=1)
    assert STREAM.ingest(spark, src, **args) == 1
    month_file(ts2, "yellow_tripdata_2016-08.parquet")          # arrives after the first run
    assert STREAM.ingest(spark, src, **args) == 1                # only the new file
    got = {(r.month, r.pickup_ts) for r in L.read_silver_trips(spark, f"{workdir}/silver").collect()}
    assert got == {(7, ts1[0]), (8, ts2[0]), (8, ts2[1])}


def test_silver_build_in_partition_groups_equals_single_job(spark, workdir):
    raw_tree(f"{workdir}/raw")
    files = R.discover_files(spark, f"{workdir}/raw")
    entries = SV.manifest_entries_for(files, "city")
    one = SV.build_trips(spark, files, entries, f"{workdir}/one").first()
    grouped = SV.build_trips(spark, files, entries, f"{workdir}/grouped", batch_files=1).first()
    assert (one.expected, one.found) == (grouped.expected, grouped.found) == (4, 4)
    a = sorted(map(tuple, L.read_silver_trips(spark, f"{workdir}/one").collect()), key=repr)
    b = sorted(map(tuple, L.read_silver_trips(spark, f"{workdir}/grouped").collect()), key=repr)
    assert a == b


def test_file_groups_keep_partitions_whole():
    from collections import namedtuple
    Row = namedtuple("Row", "path vehicle_type year month")
    rows = [Row("a1", "y", 2016, 1), Row("a2", "y", 2016, 1), Row("b", "y", 2016, 2), Row("c", "g", 2016, 1)]
    groups = SV.file_groups(rows, batch_files=1)
    assert sorted(map(sorted, groups)) == [["a1", "a2"], ["b"], ["c"]]
    assert SV.file_groups(rows) == [["c", "a1", "a2", "b"]]


def _month_file(path, ts, strings=False):
    n = len(ts)
    _write(path, pa.table({"VendorID": pa.array([1] * n, pa.int32()), "tpep_pickup_datetime": pa.array(ts, pa.string() if strings else pa.timestamp("us")),
                           "tpep_dropoff_datetime": pa.array(ts, pa.string() if strings else pa.timestamp("us")),
                           "trip_distance": [1.0] * n, "total_amount": [5.0] * n}))


def test_late_and_changed_files_rebuild_their_partition(spark, workdir):
    raw, silver = f"{workdir}/raw", f"{workdir}/silver"
    _month_file(f"{raw}/yellow_tripdata_2016-07.parquet", [dt.datetime(2016, 7, 1, 8), dt.datetime(2016, 7, 2, 8)])

    def build():
        files = R.discover_files(spark, raw)
        return SV.build_trips(spark, files, SV.manifest_entries_for(files, "city"), silver).first()

    assert build().expected == 2
    _month_file(f"{raw}/part2_yellow_tripdata_2016-07.parquet", [dt.datetime(2016, 7, 3, 8)])       # a later file of a committed month
    check = build()
    assert (check.expected, check.found, check.pending, check.ok) == (3, 3, 0, True)
    _month_file(f"{raw}/part2_yellow_tripdata_2016-07.parquet", [dt.datetime(2016, 7, d, 8) for d in (3, 4, 5, 6)])    # and a changed one
    assert build().found == 6 and build().expected == 0
    assert L.read_silver_trips(spark, silver).count() == 6


def test_stream_keeps_all_files_of_a_month_and_only_the_window(spark, workdir):
    src = f"{workdir}/incoming"
    for i, ts in enumerate(([dt.datetime(2016, 7, 1, 8)], [dt.datetime(2016, 7, 2, 8), None], [dt.datetime(2016, 7, 3, 8), dt.datetime(1903, 1, 1)])):
        _month_file(f"{src}/part{i}_yellow_tripdata_2016-07.parquet", ts)
    schema = spark.read.parquet(src).schema
    args = dict(raw_schema=schema, silver_base=f"{workdir}/silver", checkpoint=f"{workdir}/ckpt", window_years=(2016, 2016), max_files_per_trigger=1)
    assert STREAM.ingest(spark, src, **args) == 3
    _month_file(f"{src}/late_yellow_tripdata_2016-07.parquet", [dt.datetime(2016, 7, 9, 8)])
    assert STREAM.ingest(spark, src, **args) == 1
    days = sorted(r.pickup_ts.day for r in L.read_silver_trips(spark, f"{workdir}/silver").collect())
    assert days == [1, 2, 3, 9]


def test_stream_rebuilds_a_partition_once_from_its_own_folders(spark, workdir, monkeypatch):
    src, reads, rebuilt = f"{workdir}/incoming", [], STREAM._rebuilt
    rows = [("yellow", 2016, m, m * 10 + i) for m in (1, 2, 3) for i in range(2)]
    for i in range(2):                                                       # two files a month, one to a micro-batch
        df = spark.createDataFrame([r for r in rows if r[3] % 10 == i], "vehicle_type string, year int, month int, n int")
        (df.selectExpr("*", "timestamp_ntz '2016-07-01 08:00:00' tpep_pickup_datetime", "double(n) trip_distance").drop("n")
         .coalesce(1).write.mode("append").partitionBy("vehicle_type", "year", "month").parquet(src))

    def counted(spark, raw_dir, raw_schema, touched, *rest):
        norm, paths = rebuilt(spark, raw_dir, raw_schema, touched, *rest)
        plan = norm._jdf.queryExecution().executedPlan()
        reads.append((len(touched), "PartitionFilters: [" in plan.toString(), "Join" in plan.toString()))
        return norm, paths

    monkeypatch.setattr(STREAM, "_rebuilt", counted)
    args = dict(raw_schema=spark.read.parquet(src).schema, silver_base=f"{workdir}/silver", checkpoint=f"{workdir}/ckpt",
                window_years=(2016, 2016), tag_from_name=False, max_files_per_trigger=1)
    assert STREAM.ingest(spark, src, **args) == 6 and STREAM.ingest(spark, src, **args) == 0
    assert reads == [(1, True, False)] * 3
    kept = L.read_silver_trips(spark, f"{workdir}/silver")
    assert sorted((r.month, int(r.trip_distance)) for r in kept.collect()) == sorted((r[2], r[3]) for r in rows)


def test_dirty_strings_in_a_modern_file_become_null(spark, workdir):
    path = f"{workdir}/yellow_tripdata_2016-07.parquet"
    _month_file(path, ["2016-07-01 08:00:00", "not a time", None], strings=True)
    got = R.read_raw_trips(spark, [path]).collect()
    assert sorted(str(r.pickup_ts) for r in got) == ["2016-07-01 08:00:00", "None", "None"]


def test_merge_takes_the_latest_run(spark):
    schema = "key string, size long, vehicle_type string, year int, month int, run int"
    old = spark.createDataFrame([("a", 9, "y", 2016, 1, 1), ("a", 2, "y", 2016, 1, 2)], schema)
    for frame in (old, old.orderBy("run", ascending=False).coalesce(1)):
        assert [r["size"] for r in A.merge_entries(frame, old.limit(0)).collect()] == [2]


def test_rerun_without_weather_leaves_no_stale_rows(spark, workdir):
    from metrolake.plans import gold
    raw_tree(f"{workdir}/raw")
    files = R.discover_files(spark, f"{workdir}/raw")
    SV.build_trips(spark, files, SV.manifest_entries_for(files, "city"), f"{workdir}/silver")
    trips = L.read_silver_trips(spark, f"{workdir}/silver")
    weather = spark.createDataFrame([(dt.datetime(2016, 7, 1, 8), 21.0, 0.0, 0.0, 0, 3.0)],
                                    "ts timestamp_ntz, temperature double, precipitation double, snowfall double, weather_code int, wind_speed double")
    for w, n in ((weather, 1), (None, 0)):
        gold.run(spark, trips.drop("tip_amount"), w, f"{workdir}/gold", dataset_id="city")
        rows = L.read_mart(spark, f"{workdir}/gold/city/weather_deviation/rows", "annee int, condition string")
        assert rows.count() == n
        done = A.mart_completeness(gold.present_marts(spark, f"{workdir}/gold")).first()
        assert done.complet, done.manquants                     # an empty mart and a missing zone file are served as empty


def test_file_names_are_parsed_once_a_file(spark, workdir):
    for folder, at in (("a", "2016-07-01 08:00:00"), ("b", "2016-07-02 08:00:00"), ("c d%20", "2016-08-01 08:00:00")):
        os.makedirs(f"{workdir}/{folder}")
        _month_file(f"{workdir}/{folder}/yellow_tripdata_{at[:7]}.parquet", [at, at], strings=True)
    trips = R.read_raw_trips(spark, [r.path for r in R.discover_files(spark, workdir).collect()])
    got = sorted((r.pickup_ts.day, r.vehicle_type, r.year, r.month) for r in trips.collect())
    assert got == [(1, "yellow", 2016, 7)] * 2 + [(1, "yellow", 2016, 8)] * 2 + [(2, "yellow", 2016, 7)] * 2   # no row twice for a name in two folders
    side = [x for x in trips._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.lstrip().startswith(":")]
    assert side and not any("regexp_extract" in x for x in side)       # the rows meet the names' tags in a join
