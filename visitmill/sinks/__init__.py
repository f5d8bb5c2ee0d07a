"""Writes."""
