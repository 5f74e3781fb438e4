"""tessera: Spark-native re-expression of a portfolio of collect / cleanse /
normalise / analyse projects (retail orders, a title catalogue, business
reviews, food orders).

Every operator takes and returns lazy DataFrames built from built-in
``pyspark.sql.functions``; nothing is collected to the driver.
"""

__version__ = "0.1.0"
