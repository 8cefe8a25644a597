"""Reusable DataFrame operators, driven by contracts or plain parameters."""
