"""PySpark-native corpus and analytics operators."""
