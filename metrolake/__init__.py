"""metrolake: trip-data analytics as Spark DataFrame plans.

Layers: ``sources`` (raw files, lake tables, surrogate views), ``operators``
(normalization, marts, weather, serving, manifest bookkeeping), ``plans``
(silver build, gold rollups, registered queries) and ``streaming`` (file
stream ingestion).
"""

__version__ = "0.1.0"
