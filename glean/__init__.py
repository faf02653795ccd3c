"""glean — a Spark-native engine that turns raw code files, question/answer
threads and test-script projects into a clean instruction corpus.

Every operator is a ``DataFrame -> DataFrame`` transform built from Spark's
own expressions, joins, windows and aggregations (see ``glean.operators``).
"""

__version__ = "0.1.0"
