"""Trip, weather and zone tables derived from the driver's benchmark tables.

The benchmark directory holds TPC-H-like tables, not taxi files, so these
views re-shape them into the canonical trip / weather / zone layout. Every
view is a narrow projection of one scan (plus one small aggregation for the
weather hours), so its size grows with the source table. Money columns are
DECIMAL so sums are exact in any engine.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake.functions.expressions import hour_start


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c, p=18, s=2):
    return c.cast(f"decimal({p},{s})")


def trips_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per event: one month, all hours, five vehicle types."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        eid.alias("trip_id"),
        F.col("event_type").alias("vehicle_type"),
        F.col("ts").alias("pickup_ts"),
        F.year("ts").cast("int").alias("year"),
        F.month("ts").cast("int").alias("month"),
        (F.col("user_id") % 265 + 1).cast("int").alias("pulocation_id"),
        F.when(eid % 11 == 0, F.lit(None)).otherwise((eid % 97 + 1).cast("int"))
         .cast("int").alias("dolocation_id"),
        _dec(F.regexp_extract("props", "[0-9]+", 0).cast("int") * F.lit(0.25).cast("decimal(2,2)"))
        .alias("trip_distance"),
        F.when(eid % 13 == 0, F.lit(None)).otherwise(_dec(F.col("value")))
         .cast("decimal(18,2)").alias("total_amount"),
    )


def weather_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather row per event hour, with NULL codes and NULL temperatures."""
    ev = table(spark, sf_dir, "events")
    h = (ev.groupBy(hour_start("ts").alias("ts"))
           .agg(F.sum("event_id").cast("bigint").alias("sid")))
    sid = F.col("sid")
    return h.select(
        "ts",
        F.when(sid % 19 == 0, F.lit(None)).otherwise((sid % 45 - 8).cast("double"))
         .cast("double").alias("temperature"),
        F.when(sid % 17 == 0, F.lit(None)).otherwise((sid % 100).cast("int"))
         .cast("int").alias("weather_code"),
    )


def trips_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item: seven years, surcharges that start late, 'fhv' without fares."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*trips_l_columns(li))


def trips_l_columns(li: DataFrame) -> list:
    """Column expressions of the line-item trip view over a lineitem frame."""
    flag, ship = F.col("l_returnflag"), F.col("l_shipdate")
    yr = F.year(ship)
    price = _dec(F.col("l_extendedprice"))
    tax = F.col("l_tax").cast("decimal(4,2)")
    null = F.lit(None)
    return [
        F.when(flag == "A", "yellow").when(flag == "N", "green").otherwise("fhv").alias("vehicle_type"),
        ship.alias("pickup_ts"),
        yr.cast("int").alias("year"),
        F.month(ship).cast("int").alias("month"),
        F.when(yr < 1996, null).otherwise((F.col("l_suppkey") % 265 + 1).cast("int"))
         .cast("int").alias("pulocation_id"),
        F.when((yr < 1996) | (F.col("l_partkey") % 29 == 0), null)
         .otherwise((F.col("l_partkey") % 265 + 1).cast("int")).cast("int").alias("dolocation_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(0).cast("decimal(18,2)"))
         .otherwise(_dec(F.col("l_quantity"))).alias("trip_distance"),
        price.alias("total_amount"),
        F.when(flag == "R", null).otherwise(price).cast("decimal(18,2)").alias("fare_amount"),
        F.when(flag == "R", null).otherwise((price * tax).cast("decimal(18,4)"))
         .cast("decimal(18,4)").alias("tip_amount"),
        _dec(F.col("l_discount").cast("decimal(4,2)") * 10).alias("extra"),
        F.when(yr < 1998, null).otherwise(_dec(tax * 10)).cast("decimal(18,2)")
         .alias("improvement_surcharge"),
        F.when((yr < 2000) | (flag != "A"), null).otherwise(_dec(F.col("l_linenumber")))
         .cast("decimal(18,2)").alias("congestion_surcharge"),
    ]


def zones_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension covering only some ids, so the 'Zone <id>' fallback is used."""
    sup = table(spark, sf_dir, "supplier")
    nat = table(spark, sf_dir, "nation")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
               .select((F.col("s_suppkey") + 1).cast("int").alias("location_id"),
                       F.col("s_name").alias("zone"), F.col("n_name").alias("borough")))


# Surcharge columns the lineitem surrogate carries.
TRIPS_L_SURCHARGES = ["extra", "improvement_surcharge", "congestion_surcharge"]
# Price-bin width that fills all ten bins on lineitem prices.
TRIPS_L_BIN_WIDTH = 200.0
