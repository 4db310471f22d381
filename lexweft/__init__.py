"""lexweft: a Spark-native engine for analysing large, layered text collections."""

__version__ = "0.1.0"
