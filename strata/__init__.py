"""strata: layered (raw -> cleansed -> mart) data processing on Spark.

Operators are pure ``DataFrame -> DataFrame`` functions with explicit
parameters (time, load date, keys).  They never trigger actions; the thin
publishing layer in ``strata.sources.publish`` is the only place that writes.
"""

__version__ = "0.1.0"
