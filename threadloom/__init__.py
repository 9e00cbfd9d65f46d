"""PySpark-native analytics for threaded discussions."""
