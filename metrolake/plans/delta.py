"""Rollups R1-R3 kept up to date by partition.

The rollups are stored by (vehicle, year, month), the partitions of the silver table.
All their measures are additive, so a partition's slice depends on that partition
alone: when files were committed since the last refresh, only the partitions they
touched are read, and only their slices are replaced (dynamic partition overwrite).
Marts re-aggregate the slices, as they do for rollups of one run.

A refresh first replaces the slices and then records the files they contain, so an
interrupted refresh is simply repeated.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from metrolake import constants as K
from metrolake.plans import gold, silver as SV
from metrolake.schemas import TRIP_SCHEMA
from metrolake.sources import lake as L

KEYS = ["vehicle_type", "year", "month"]


def _partition() -> Column:
    """A partition as one text; built of partition columns only, so that filters on it prune folders."""
    return F.concat_ws("/", *[F.col(k).cast("string") for k in KEYS])


class StoredRollups(gold.Rollups):
    """The rollups of ``silver_base`` in ``base``; all marts of :class:`gold.Rollups` read them."""

    def __init__(self, spark: SparkSession, silver_base: str, base: str, surcharges=K.SURCHARGES, width=K.BIN_WIDTH, nbins=K.NBINS):
        super().__init__(spark.createDataFrame([], TRIP_SCHEMA), surcharges, width, nbins, base.rstrip("/"))
        self.spark, self.silver = spark, silver_base

    def _slices(self, trips: DataFrame) -> dict[str, DataFrame]:
        return {"r1": gold.rollup_hourly_zone(trips, self.surcharges), "r2": gold.rollup_od(trips, KEYS),
                "r3": gold.rollup_price_bins(trips, self.width, self.nbins, KEYS)}

    def changed(self) -> DataFrame:
        """Committed files that the rollups do not contain yet (path, size and partition)."""
        merged = L.read_if_present(self.spark, SV.COMMITTED_SCHEMA, f"{self._base}/_merged")
        return SV.pending_files(SV.committed_files(self.spark, self.silver), merged)

    def touched_trips(self, files: DataFrame) -> DataFrame:
        """The trips of the partitions of ``files``; only file metadata reaches the driver."""
        parts = [r[0] for r in files.select(_partition()).distinct().collect()]
        return L.read_silver_trips(self.spark, self.silver).where(_partition().isin(parts))

    def refresh(self) -> int:
        """Replace the slices of all partitions with newly committed files; returns the number of these files."""
        files = self.spark.createDataFrame(self.changed().collect(), SV.COMMITTED_SCHEMA)      # file metadata only
        n = files.count()
        if not n:
            return 0
        slices = self._slices(self.touched_trips(files))

        def replace(name: str) -> None:
            # a slice is bounded by its key domain (hours x zones, zones x zones, zones x bins), so one task a partition writes it
            (slices[name].repartition(*KEYS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*KEYS).parquet(f"{self._base}/{name}"))

        with ThreadPoolExecutor(max_workers=3) as pool:
            list(pool.map(replace, slices))
        files.coalesce(1).write.mode("append").parquet(f"{self._base}/_merged")
        return n

    def _rollup(self, name: str) -> DataFrame:
        """A stored rollup as it is now."""
        schema = self._slices(self.spark.createDataFrame([], TRIP_SCHEMA))[name].schema
        return L.read_if_present(self.spark, schema, f"{self._base}/{name}")
