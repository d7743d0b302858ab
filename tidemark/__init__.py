"""tidemark: a Spark-native change-data-capture and replica engine."""

__version__ = "0.1.0"
