"""A PySpark-native engine for enriching and analysing large text and catalogue collections."""
