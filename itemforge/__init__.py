"""itemforge: a Spark-native engine for building and querying an exam item bank."""

__version__ = "0.1.0"
