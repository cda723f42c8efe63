"""Additive measures: totals that can be stored per group, regrouped, and read back
as means and ratios. The direct marts and the shared rollups use the same ones."""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from metrolake.functions import expressions as X

# Trips with a price per distance: how many, their totals and their distances.
PRICED: dict[str, Column | str | None] = {"courses": None, "somme_total": "total_amount", "somme_km": "trip_distance"}


def totals(measures: Mapping[str, Column | str | None]) -> list[Column]:
    """One aggregate for each measure: the sum of its input, or the row count where it has none."""
    return [(F.count(F.lit(1)) if source is None else F.sum(source)).alias(name) for name, source in measures.items()]


def regrouped(df: DataFrame, keys: Iterable[str], **named: str) -> DataFrame:
    """Rows of PRICED totals summed to ``keys`` (named: key = column it is read from), with
    their price per distance as a ratio of sums."""
    keys = [F.col(named.get(k, k)).alias(k) for k in keys]
    out = df.groupBy(*keys).agg(*totals({m: m for m in PRICED}))
    rest = [c for c in out.columns if c not in PRICED]
    return out.select(*rest, "courses", X.ratio("somme_total", "somme_km").alias("prix_km_moyen"))


def mean_and_total(name: str, total: Column, count: Column) -> list[Column]:
    """``<name>_moyen`` and ``<name>_total`` from a total and the count of its values."""
    return [X.round_to_double(F.try_divide(total, count)).alias(f"{name}_moyen"), X.round_to_double(total).alias(f"{name}_total")]
