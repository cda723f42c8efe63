"""Raw trip variants -> the canonical trip model.

All decisions are made at plan time from the raw frame's column names (one
projection per schema fingerprint); the per-row work is a single narrow
``select`` of casts, so Catalyst collapses it into the scan's codegen stage.
A surcharge missing from a raw layout becomes a typed NULL, never 0.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from metrolake import constants as K
from metrolake.functions.expressions import parse_wall_clock
from metrolake.schemas import CANONICAL_COLUMNS


def is_legacy(columns, sentinel: str = K.LEGACY_SENTINEL, strict_case: bool = False) -> bool:
    """B1: the legacy layout carries the sentinel column."""
    if strict_case:
        return sentinel in columns
    return sentinel.lower() in {c.lower() for c in columns}


def pick_source(columns, candidates, strict_case: bool = False) -> str | None:
    """B2: first candidate present in the raw columns (case-insensitive unless strict)."""
    if strict_case:
        present = set(columns)
        return next((c for c in candidates if c in present), None)
    lower = {c.lower(): c for c in columns}
    return next((lower[c.lower()] for c in candidates if c.lower() in lower), None)


def canonical_column(raw: T.StructType, name: str, dtype: T.DataType, aliases, strict_case: bool = False,
                     ts_format: str = K.LEGACY_TS_FORMAT) -> Column:
    """One canonical column: chosen source, typed NULL when absent, everything
    cast without failing on dirty values. Times by their raw type: text is parsed,
    an instant is taken as its UTC wall clock, whatever the session's zone."""
    src = pick_source(raw.names, aliases.get(name, []), strict_case)
    if src is None:
        return F.lit(None).cast(dtype).alias(name)                      # B3
    c = F.col(f"`{src}`")
    if isinstance(dtype, T.TimestampNTZType):
        if isinstance(raw[src].dataType, T.StringType):
            c = parse_wall_clock(c, ts_format)                          # B5
        elif isinstance(raw[src].dataType, T.TimestampType):
            seconds = (F.unix_micros(c).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
            c = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        return c.try_cast("timestamp_ntz").alias(name)
    return c.try_cast(dtype).alias(name)                                # B4


def normalize(raw: DataFrame, aliases: dict | None = None, strict_case: bool = False,
              keep: list[str] | None = None) -> DataFrame:
    """Project a raw frame of one schema fingerprint onto the 22 canonical
    columns in canonical order; ``keep`` passes extra columns through (tags)."""
    cols = raw.columns
    legacy = is_legacy(cols, strict_case=strict_case)
    amap = aliases or (K.LEGACY_ALIASES if legacy else K.MODERN_ALIASES)
    out = [canonical_column(raw.schema, n, t, amap, strict_case) for n, t in CANONICAL_COLUMNS]
    return raw.select(*out, *[F.col(k) for k in (keep or [])])


def tag_from_file_name(df: DataFrame, name_col: Column | None = None,
                       pattern: str = K.TRIP_FILE_PATTERN) -> DataFrame:
    """Partition tags parsed from each row's source file name
    (``_metadata.file_name`` of a file scan)."""
    name = name_col if name_col is not None else F.col("_metadata.file_name")
    return df.select("*",
                     F.regexp_extract(name, pattern, 1).alias("vehicle_type"),
                     F.regexp_extract(name, pattern, 2).cast("int").alias("year"),
                     F.regexp_extract(name, pattern, 3).cast("int").alias("month"))


def union_all(frames) -> DataFrame:
    """Union of normalized frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def time_window(year_lo, year_hi) -> tuple[Column, Column]:
    """[lo-01-01 00:00:00, hi-12-31 23:59:59] as NTZ timestamps (columns or ints)."""
    lo = year_lo if isinstance(year_lo, Column) else F.lit(int(year_lo))
    hi = year_hi if isinstance(year_hi, Column) else F.lit(int(year_hi))
    return (F.make_timestamp_ntz(lo, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)),
            F.make_timestamp_ntz(hi, F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59)))


def keep_in_window(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Keep lo <= pickup_ts <= hi (inclusive); NULL timestamps drop out."""
    return df.filter(F.col("pickup_ts").between(lo, hi))


def keep_in_manifest_window(df: DataFrame, manifest_entries: DataFrame) -> DataFrame:
    """B8 + A22: window from min/max year over all manifest entries.

    The manifest holds one row per raw file, so its two bounds are read with
    one small action and applied as literals: the filter is then constant-folded
    into every branch of the trip union instead of carrying a subquery that
    each branch would re-evaluate."""
    bounds = manifest_bounds(manifest_entries)
    if bounds is None:
        return df.limit(0)
    return keep_in_window(df, *bounds)


def manifest_bounds(manifest_entries: DataFrame):
    """(lo, hi) window columns from the manifest's min/max year; None when empty."""
    b = manifest_entries.agg(F.min("year").alias("lo"), F.max("year").alias("hi")).first()
    if b is None or b.lo is None:
        return None
    return time_window(int(b.lo), int(b.hi))


def keep_in_file_month(df: DataFrame) -> DataFrame:
    """Optional strict window (Q1): keep trips whose pickup falls in the month
    their file is named after (partition tags ``year``/``month``)."""
    return df.filter((F.year("pickup_ts") == F.col("year")) & (F.month("pickup_ts") == F.col("month")))
