"""Galena: a PySpark-native engine for register, offer and text data."""
