"""martlens: e-commerce behaviour and order analytics on Spark.

Batch tables and Structured Streaming queries share the same DataFrame
transforms; see README.md for the operator map.
"""

__version__ = "0.1.0"
