"""Spark-native record matching and scoring."""
