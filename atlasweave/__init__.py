"""Spark-native cleaning, assessment and linkage of point-of-interest tables."""
