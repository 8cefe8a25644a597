"""Layered (bronze, silver, gold) analytics with quality gates, on PySpark DataFrames."""
