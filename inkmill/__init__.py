"""inkmill: a PySpark-native engine for collecting, triaging and curating document collections."""

__version__ = "0.1.0"
