"""Spark-native link ranking, global ordering and data-parallel SGD over DataFrames."""
