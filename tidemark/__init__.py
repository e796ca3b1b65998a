"""tidemark: per-instrument market time-series analytics on PySpark.

Bars, indicators, supervised datasets, per-symbol forecast models, run and
registry tables, snapshot inventory and health reports, all expressed as
Spark DataFrames (batch) or Structured Streaming queries.
"""

__version__ = "0.1.0"
