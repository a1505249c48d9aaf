"""Spark-native analytics over long histories of daily security prices."""
