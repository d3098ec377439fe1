"""tessera: Spark-native tabular in-context analytics."""

__version__ = "0.1.0"
