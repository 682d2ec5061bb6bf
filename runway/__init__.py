"""runway — on-time-performance analytics for flights-shaped tables on PySpark.

Layers:

* ``runway.sources``   — explicit schema, schema guard, partitioned scans,
  zipped landing, test fixtures derived from the driver tables.
* ``runway.functions`` — reusable ``Column`` builders (operated, on-time,
  zero-safe percent, bands, day names, time periods, marker fields).
* ``runway.operators`` — data-quality rules, the eight Gold tables and the
  incremental-state table operators; every operator is DataFrame → DataFrame.
* ``runway.plans``     — job shapes that compose operators: Silver run,
  Gold run, trend recompute, partitioned sinks, external SQL sets.
* ``runway.streaming`` — the Silver step as an ``availableNow`` file stream.
"""

__version__ = "0.1.0"
