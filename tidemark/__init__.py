"""tidemark: layered, incremental commerce analytics on Spark.

Every transformation is a function from DataFrames to DataFrames; the only code that
touches paths lives in :mod:`tidemark.sources`.
"""

__version__ = "0.1.0"
