"""Readers of delimited files and frames derived from star-schema tables."""
