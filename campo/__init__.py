"""campo — sensor-telemetry analytics for irrigation pivots, written as Spark
DataFrame transformations.

Every public operator is a ``DataFrame -> DataFrame`` function (or returns a
small driver-side value derived from an aggregate), so the same code runs in
batch, in Structured Streaming and on a cluster.
"""

__version__ = "0.1.0"
