"""A PySpark-native engine for declared tables over files."""
