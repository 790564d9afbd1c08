"""climark: Spark-native analytics for daily station observations.

Every operator is a ``DataFrame -> DataFrame`` function built from
``pyspark.sql`` expressions, joins, aggregates and windows, chained with
``df.transform``.  Nothing is collected to the driver except bounded
results (per-iteration model metrics, row counts used for size checks).
"""

__version__ = "0.1.0"
