"""Spark-native analytics over road maps: relational map tables, polyline and plan-view geometry, blocked and grid
joins, graph passes, rule checks and data-preparation operators, all as DataFrame -> DataFrame functions."""
