"""listinglab — Spark-native listing and review analytics.

Every operator takes and returns a DataFrame (or a dict of DataFrames) and
is built from native Spark expressions, joins, aggregates and windows, so
Catalyst can push filters into the scan, prune columns and pick join
strategies, and AQE can re-plan at runtime.
"""

__version__ = "0.1.0"
