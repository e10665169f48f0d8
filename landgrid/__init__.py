"""Landgrid: a PySpark-native engine for archives of land and well records."""
