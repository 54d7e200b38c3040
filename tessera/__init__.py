"""tessera: user-profile and order-KPI analytics as Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions (Java-compatible parsing, IP arithmetic)
sources     text / stream readers and inputs derived from the driver tables
operators   DataFrame -> DataFrame building blocks (usage, tags, profile, orders ...)
plans       multi-step jobs: size-checked broadcast, snapshot store, text round trip
streaming   Structured Streaming order KPIs, hourly archive and compaction
"""

__version__ = "0.1.0"
