"""A PySpark-native analytics library for event, payment and case data."""
