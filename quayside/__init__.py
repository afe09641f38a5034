"""Spark-first analytics for markets, statements, bonds, ports, news and property."""
