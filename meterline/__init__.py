"""Spark-native trip-record analytics: landing files to audited, tested marts."""
