"""Assess database estates from catalog and performance-history extracts, on Spark."""
