"""claimlake: a Spark-native revenue-cycle lakehouse.

Bronze loads, a common data model, quality flags, SCD2 history, registry
JSON flattening, a star schema and charge reports -- each a tested
DataFrame -> DataFrame function on stock Apache Spark.
"""

__version__ = "0.1.0"
