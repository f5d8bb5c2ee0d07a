"""Scans of landed files, JSON pages and tables."""
