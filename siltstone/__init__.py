"""Siltstone: a PySpark-native engine for message-and-record feeds."""
