"""Catalogue building and record linkage as Spark DataFrame jobs."""
