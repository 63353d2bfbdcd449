"""Spark-native analytics for blocked, labelled volumes and the graphs derived from them."""
