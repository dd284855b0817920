"""Spark-native territorial analytics: sources, functions, operators, plans and streaming."""
