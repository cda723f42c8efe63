"""Raw inputs: trip parquet files, weather JSON documents, zone CSV."""
from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from metrolake import constants as K
from metrolake.operators import normalize as N
from metrolake.schemas import WEATHER_RAW_SCHEMA, ZONE_SCHEMA


def discover_files(spark: SparkSession, root: str, pattern: str = K.TRIP_FILE_PATTERN) -> DataFrame:
    """A10: recursive listing of ``<vehicle>_tripdata_<YYYY>-<MM>.parquet`` files as a
    DataFrame (path, name, size, vehicle_type, year, month), sorted by path.
    Only file metadata is read: selecting ``path, length`` prunes the content."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    named = files.select("path", name.alias("name"), F.col("length").alias("size"))
    return parse_file_names(named, pattern).orderBy("path")


def parse_file_names(files: DataFrame, pattern: str = K.TRIP_FILE_PATTERN) -> DataFrame:
    """A10: keep names where the pattern is found (search, not full match) and
    extract vehicle type, year and month from its groups."""
    return (files.filter(F.col("name").rlike(pattern))
                 .withColumn("vehicle_type", F.regexp_extract("name", pattern, 1))
                 .withColumn("year", F.regexp_extract("name", pattern, 2).cast("int"))
                 .withColumn("month", F.regexp_extract("name", pattern, 3).cast("int")))


def sample_files(files: DataFrame, n: int = 0) -> DataFrame:
    """The first ``n`` files in path order (0 = all)."""
    return files.orderBy("path").limit(n) if n and n > 0 else files


def schema_fingerprints(spark: SparkSession, paths, threads: int = 16) -> dict[str, list[str]]:
    """Group raw files by their parquet schema, so each group can be scanned
    with one reader: int/double drift between files of one layout cannot be
    merged by the parquet reader. Only footers are read (one per file, a few
    hundred monthly files in practice), concurrently from the driver."""
    paths = list(paths)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(paths)))) as pool:
        schemas = list(pool.map(lambda p: spark.read.parquet(p).schema.json(), paths))
    groups: dict[str, list[str]] = defaultdict(list)
    for p, fp in zip(paths, schemas):
        groups[fp].append(p)
    return dict(groups)


def file_tags(spark: SparkSession, paths) -> DataFrame:
    """The tags of each file name (``_file_name``), parsed once a file. Only file metadata is read."""
    names = spark.read.format("binaryFile").load(list(paths)).select(F.col("_metadata.file_name").alias("_file_name")).distinct()
    return N.tag_from_file_name(names, F.col("_file_name"))


def read_raw_trips(spark: SparkSession, paths, strict_case: bool = False) -> DataFrame:
    """A1 + B1-B7: scan raw trip files (one scan per schema fingerprint), normalize
    each scan, tag rows from their file name, and union by name. The tags come from a
    broadcast of the file names: the pattern is not searched again for every row."""
    frames, tags = [], F.broadcast(file_tags(spark, paths))
    for _fp, group in sorted(schema_fingerprints(spark, paths).items(), key=lambda kv: kv[1][0]):
        raw = spark.read.parquet(*group)
        with_name = raw.select("*", F.col("_metadata.file_name").alias("_file_name"))
        norm = N.normalize(with_name, strict_case=strict_case, keep=["_file_name"])
        frames.append(norm.join(tags, "_file_name").drop("_file_name"))
    return N.union_all(frames)


def weather_documents(spark: SparkSession, root: str) -> DataFrame:
    """The monthly weather documents under ``root``, ``<year>/<MM>.json`` or ``year=<y>/month=<m>/*.json``,
    as (path, year, month). Only file metadata is read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(root).select("path"))
    pattern = r"/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})(?:\.json|/)"
    part = lambda i: F.regexp_extract("path", pattern, i).try_cast("int")
    return files.select("path", part(1).alias("year"), part(2).alias("month")).where("month is not null")


def read_weather_json(spark: SparkSession, *paths: str) -> DataFrame:
    """A2 + B10-B12: raw monthly weather documents ``<root>/<year>/<MM>.json`` with an
    explicit schema; the year comes from each file's path. Takes a root or the documents' paths."""
    from metrolake.operators.weather import explode_hourly
    raw = (spark.read.schema(WEATHER_RAW_SCHEMA).option("recursiveFileLookup", "true")
           .option("pathGlobFilter", "*.json").json(list(paths)))
    # year = the last 4-digit directory of the path (``.../2016/01.json`` or ``.../year=2016/...``)
    year = F.regexp_extract(F.col("_metadata.file_path"), r".*/(?:year=)?(\d{4})/", 1)
    raw = raw.select("hourly", year.cast("int").alias("year"))
    return explode_hourly(raw, "year")


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """A5: zone lookup CSV with a header (LocationID, Borough, Zone, ...), columns
    taken by name; an empty frame when the file is missing."""
    try:
        z = spark.read.option("header", "true").csv(path)
        z.columns  # resolves the path
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ZONE_SCHEMA)
    return z.select(F.col("LocationID").try_cast("int").alias("location_id"),
                    F.col("Zone").alias("zone"), F.col("Borough").alias("borough"))
