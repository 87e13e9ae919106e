"""PySpark-native engine for reciprocal-space maps."""
