"""A PySpark-native engine for large-scale entity resolution and the analytics around it."""
