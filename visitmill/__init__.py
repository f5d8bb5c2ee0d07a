"""Visitmill: land, normalize and check clinical-trial extracts as Spark jobs."""
