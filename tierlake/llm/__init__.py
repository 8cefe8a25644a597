"""Operators of a training-data pipeline: filters, scans, sketches, mixing and encoding."""
