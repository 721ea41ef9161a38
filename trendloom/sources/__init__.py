"""Scans of the stored tables and of landed data."""
