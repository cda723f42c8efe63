"""Raw layouts -> canonical model (B1-B9) on hand-made frames."""
import datetime as dt

from pyspark.sql import functions as F

from metrolake.operators import normalize as N
from metrolake.schemas import CANONICAL_COLUMNS

CANON = [n for n, _ in CANONICAL_COLUMNS]


def legacy(spark):
    return spark.createDataFrame(
        [("VTS", "2009-01-04 02:52:00", "2009-01-04 03:02:00", 1, 2.63, -73.99, 40.72, -73.95, 40.77, "CASH",
          8.9, 0.5, None, 0.0, 0.0, 9.4),
         ("CMT", "garbage", "2009-01-04 03:02:00", 2, 1.0, None, None, None, None, "Credit", 5.0, 0.0, None, 1.0,
          0.0, 6.0)],
        "vendor_name string, Trip_Pickup_DateTime string, Trip_Dropoff_DateTime string, Passenger_Count long, "
        "Trip_Distance double, Start_Lon double, Start_Lat double, End_Lon double, End_Lat double, "
        "Payment_Type string, Fare_Amt double, surcharge double, mta_tax double, Tip_Amt double, "
        "Tolls_Amt double, Total_Amt double")


def test_legacy_layout_parses_strings_keeps_gps_and_nulls_zone_ids(spark):
    out = N.normalize(legacy(spark))
    assert out.columns == CANON
    rows = out.orderBy("vendor").collect()
    cmt, vts = rows
    assert vts.pickup_ts == dt.datetime(2009, 1, 4, 2, 52)
    assert cmt.pickup_ts is None                      # unparsable -> NULL, no failure
    assert vts.pickup_lon == -73.99 and vts.pulocation_id is None
    assert vts.extra == 0.5                           # legacy 'surcharge' -> extra
    assert vts.improvement_surcharge is None          # absent column -> NULL, never 0
    assert dict(out.dtypes)["pickup_ts"] == "timestamp_ntz"


def test_modern_drift_case_and_zero_vs_null(spark):
    ts = dt.datetime(2016, 8, 1, 10, 0)
    drifted = spark.createDataFrame(
        [(2, ts, ts, 1.0, 3.5, 100, 200, 1, 10.0, 0.5, 0.5, 0.3, 0.0, 2.0, 0.0, 13.3, 1.25)],
        "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double, PULocationID int, DOLocationID int, payment_type long, "
        "fare_amount double, extra double, mta_tax double, improvement_surcharge double, "
        "congestion_surcharge double, tip_amount double, tolls_amount double, total_amount double, "
        "Airport_fee double")
    r = N.normalize(drifted).first()
    assert r.vendor == "2" and r.passenger_count == 1 and r.payment_type == "1"
    assert r.congestion_surcharge == 0.0               # present and 0 stays 0
    assert r.cbd_convenience_fee is None               # absent stays NULL
    assert r.airport_fee == 1.25                       # case-insensitive alias by default
    assert N.normalize(drifted, strict_case=True).first().airport_fee is None   # exact-case rule


def test_fhv_and_fhvhv_alias_order(spark):
    ts = dt.datetime(2019, 2, 1, 0, 5)
    fhvhv = spark.createDataFrame(
        [("HV0003", "B02512", ts, 4.2, 12.0, 1.0, 0.0, 2.75, None, 61, 79)],
        "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp_ntz, "
        "trip_miles double, base_passenger_fare double, tips double, tolls double, "
        "congestion_surcharge double, airport_fee double, PULocationID int, DOLocationID int")
    r = N.normalize(fhvhv).first()
    assert r.vendor == "B02512"                        # dispatching_base_num precedes hvfhs_license_num
    assert (r.trip_distance, r.fare_amount, r.tip_amount) == (4.2, 12.0, 1.0)
    assert r.total_amount is None
    fhv = spark.createDataFrame([("B00001", ts, ts, 10.0, 20.0)],
                                "dispatching_base_num string, pickup_datetime timestamp_ntz, "
                                "dropOff_datetime timestamp_ntz, PUlocationID double, DOlocationID double")
    r = N.normalize(fhv).first()
    assert (r.pulocation_id, r.dolocation_id) == (10, 20) and r.fare_amount is None and r.trip_distance is None


def test_window_is_inclusive_and_drops_null(spark):
    rows = [(dt.datetime(2015, 12, 31, 23, 59, 59),), (dt.datetime(2016, 1, 1, 0, 0, 0),),
            (dt.datetime(2016, 12, 31, 23, 59, 59),), (dt.datetime(2017, 1, 1, 0, 0, 0),), (None,)]
    df = spark.createDataFrame(rows, "pickup_ts timestamp_ntz")
    lo, hi = N.time_window(2016, 2016)
    kept = [r.pickup_ts for r in N.keep_in_window(df, lo, hi).collect()]
    assert sorted(kept) == [dt.datetime(2016, 1, 1), dt.datetime(2016, 12, 31, 23, 59, 59)]
    manifest = spark.createDataFrame([(2016,), (2016,)], "year int")
    assert N.keep_in_manifest_window(df, manifest).count() == 2


def test_tags_from_file_name(spark):
    df = spark.createDataFrame([("yellow_tripdata_2016-07.parquet",)], "f string")
    r = N.tag_from_file_name(df, F.col("f")).first()
    assert (r.vehicle_type, r.year, r.month) == ("yellow", 2016, 7)


def test_wall_clock_parse_ignores_session_time_zone(spark):
    from metrolake.functions.expressions import parse_wall_clock
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2016-03-13 02:30:00", "2016-03-13T02:00"), ("bad", "2016-13-01T00:00")],
                                   "a string, b string")
        rows = df.select(parse_wall_clock("a", "yyyy-MM-dd HH:mm:ss").alias("a"),
                         parse_wall_clock("b", "yyyy-MM-dd'T'HH:mm").alias("b")).collect()
        assert rows[0].a == dt.datetime(2016, 3, 13, 2, 30) and rows[0].b == dt.datetime(2016, 3, 13, 2, 0)
        assert rows[1].a is None and rows[1].b is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_wall_clock_cast_takes_what_the_pattern_takes(spark):
    from metrolake.functions.expressions import parse_wall_clock
    at = lambda *x: dt.datetime(*x)
    want = {"2016-02-29 23:59:58": at(2016, 2, 29, 23, 59, 58), "2016-01-01 10:59:60": at(2016, 1, 1, 11, 0), "2016-01-01 10:59:58\n": at(2016, 1, 1, 10, 59, 58),
            "2015-02-29 23:59:58": None, "2016-01-01 24:00:00": None, "2016-01-01T10:59:58": None, "2016-01-01 10:59:5Z": None, "2016-01-01 10:59:5 ": None,
            " 2016-01-01 10:59:5": None, "2016-1-01 10:59:588": None, "2016-01-01 10:59:5": None, "+016-01-01 10:59:58": None, "2016-01-01 10:59:58.5": None,
            "2016-01-01": None, "not a time": None, "": None, None: None}
    df = spark.createDataFrame([(t,) for t in want], "t string")
    got = df.select("t", parse_wall_clock("t", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    assert {r.t: r.ts for r in got.collect()} == want
    assert "cast(t" in got._jdf.queryExecution().optimizedPlan().toString()       # well-formed text does not go through the pattern


def test_legacy_layout_formats_a_time_once(spark, workdir):
    from metrolake.plans import catalog_reconcile as B
    spark.sql("SELECT 1L AS l_orderkey, 2L AS l_partkey, 3L AS l_suppkey, id AS l_linenumber, 1D AS l_quantity, 9.5D AS l_extendedprice, 0.1D AS l_discount, "
              "0.02D AS l_tax, 'A' AS l_returnflag, 'O' AS l_linestatus, TIMESTAMP_NTZ'1996-02-29 10:11:12' AS l_shipdate FROM VALUES 1, 5, 6 AS t(id)"
              ).write.parquet(f"{workdir}/lineitem.parquet")
    raw = B.legacy_raw(B._trips_l_with_line(spark, workdir))
    assert sorted((r.Trip_Pickup_DateTime, r.Trip_Dropoff_DateTime) for r in raw.collect()) == [
        (t, "1996-02-29 10:11:12") for t in ("1896-02-29 10:11:12", "1996-02-29 10:11:12", "not a time")]
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("date_format(") == 2      # the time, and the one a hundred years before
