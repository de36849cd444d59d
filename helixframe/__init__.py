"""Spark-native operators for large biological tables: every operator takes and returns DataFrames."""
