"""Marquee: commercial-outcome analytics for released titles, on Spark.

Every operator takes and returns DataFrames (or Columns); the caller supplies
the session.  See README.md for the map from operators to modules.
"""

__version__ = "0.1.0"
