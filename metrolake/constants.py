"""Fixed values shared by the whole package.

Everything here is data, not logic: labels, alias lists, thresholds and
band edges. Callers may pass their own copies to any operator that takes
them as a parameter (labels can be swapped, alias lists extended).
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the published marts' values for the results
# to match (labels, alias lists, thresholds, band edges, default sizes).
# ---------------------------------------------------------------------------

# Weekday labels, Monday first (weekday index 0..6).
DAY_LABELS = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]

# Fare components that appeared over time in the raw schema, in mart order.
SURCHARGES = ["extra", "mta_tax", "improvement_surcharge",
              "congestion_surcharge", "airport_fee", "cbd_convenience_fee"]

TOP_ZONES = 20          # nodes of the flow graph, zones of the price histogram
TOP_LINKS = 100         # links of the flow graph
BIN_WIDTH = 1.0         # price-per-distance histogram bin width
NBINS = 10              # price-per-distance histogram bin count
MIN_ZONE_WEATHER_TRIPS = 200   # HAVING threshold of the zone x condition mart
RAIN_GATE = 200                # minimum trips behind a zone's rain / clear price

# Weather condition labels of WMO codes, as (upper bound exclusive, label);
# NULL -> UNKNOWN_CONDITION, 0 -> CLEAR_CONDITION, >= last bound -> STORM_CONDITION.
UNKNOWN_CONDITION = "Inconnu"
CLEAR_CONDITION = "Dégagé"
CONDITION_BOUNDS = [(4, "Nuageux"), (49, "Brouillard"), (70, "Pluie"),
                    (80, "Neige"), (83, "Averses"), (95, "Neige")]
STORM_CONDITION = "Orage"
# Display order of conditions (UNKNOWN_CONDITION is not listed).
CONDITIONS = ["Dégagé", "Nuageux", "Brouillard", "Pluie", "Neige", "Averses", "Orage"]
RAIN_CONDITION = "Pluie"

# Temperature bands, as (upper bound exclusive, label); NULL falls in the last.
TEMPERATURE_BOUNDS = [(0, "< 0°C"), (10, "0-10°C"), (20, "10-20°C"), (30, "20-30°C")]
TEMPERATURE_TOP = "≥ 30°C"
TEMPERATURE_BANDS = ["< 0°C", "0-10°C", "10-20°C", "20-30°C", "≥ 30°C"]

# Trip distance bands, as (upper bound exclusive, label).
DISTANCE_BOUNDS = [(1, "0-1 km"), (2, "1-2 km"), (5, "2-5 km"), (10, "5-10 km"), (20, "10-20 km")]
DISTANCE_TOP = "20+ km"
DISTANCE_BANDS = ["0-1 km", "1-2 km", "2-5 km", "5-10 km", "10-20 km", "20+ km"]
SHORT_BAND = "0-1 km"
LONG_BAND = "20+ km"

# Raw file names: <vehicle>_tripdata_<YYYY>-<MM>.parquet (lower-case vehicle).
TRIP_FILE_PATTERN = r"([a-z]+)_tripdata_(\d{4})-(\d{2})\.parquet$"

# Legacy timestamp format and weather time format.
LEGACY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
WEATHER_TS_FORMAT = "yyyy-MM-dd'T'HH:mm"

# Sentinel column telling the legacy raw layout from the modern one.
LEGACY_SENTINEL = "vendor_name"

# Canonical column -> raw names, first present wins (legacy layout).
LEGACY_ALIASES = {
    "vendor": ["vendor_name"],
    "pickup_ts": ["Trip_Pickup_DateTime"],
    "dropoff_ts": ["Trip_Dropoff_DateTime"],
    "passenger_count": ["Passenger_Count"],
    "trip_distance": ["Trip_Distance"],
    "pickup_lon": ["Start_Lon"],
    "pickup_lat": ["Start_Lat"],
    "dropoff_lon": ["End_Lon"],
    "dropoff_lat": ["End_Lat"],
    "payment_type": ["Payment_Type"],
    "fare_amount": ["Fare_Amt"],
    "extra": ["surcharge"],
    "mta_tax": ["mta_tax"],
    "tip_amount": ["Tip_Amt"],
    "tolls_amount": ["Tolls_Amt"],
    "total_amount": ["Total_Amt"],
}

# Canonical column -> raw names, first present wins (modern yellow/green/fhv/fhvhv).
MODERN_ALIASES = {
    "vendor": ["VendorID", "dispatching_base_num", "hvfhs_license_num"],
    "pickup_ts": ["tpep_pickup_datetime", "lpep_pickup_datetime", "pickup_datetime"],
    "dropoff_ts": ["tpep_dropoff_datetime", "lpep_dropoff_datetime", "dropOff_datetime"],
    "passenger_count": ["passenger_count"],
    "trip_distance": ["trip_distance", "trip_miles"],
    "pulocation_id": ["PULocationID", "PUlocationID"],
    "dolocation_id": ["DOLocationID", "DOlocationID"],
    "payment_type": ["payment_type"],
    "fare_amount": ["fare_amount", "base_passenger_fare"],
    "extra": ["extra"],
    "mta_tax": ["mta_tax"],
    "improvement_surcharge": ["improvement_surcharge"],
    "congestion_surcharge": ["congestion_surcharge"],
    "airport_fee": ["airport_fee"],
    "cbd_convenience_fee": ["cbd_convenience_fee"],
    "tip_amount": ["tip_amount", "tips"],
    "tolls_amount": ["tolls_amount", "tolls"],
    "total_amount": ["total_amount"],
}

# Marts a dataset needs before it can be served (completeness check).
REQUIRED_MARTS = ["surcharge_evolution", "zone_flows", "price_per_km_by_zone",
                  "activity_heatmap", "weather_deviation", "zone_stats", "timeline",
                  "zone_lookup", "distance", "tips"]

# Status of the weather mart when no weather has been loaded yet.
WEATHER_PENDING = "en_attente"
WEATHER_READY = "ok"
