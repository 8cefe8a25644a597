"""Marts, scorecard, reports and the full refresh, composed from the operators."""
