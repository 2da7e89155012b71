"""ledgerlake: a point-in-time research lakehouse built on Spark DataFrames.

Every public function takes DataFrames (plus plain parameters) and returns
DataFrames.  Nothing brings table rows to the driver; the only values that
reach the driver are bounded by construction (one profile row per table,
the set of partition years touched by a batch).
"""

__version__ = "0.1.0"
