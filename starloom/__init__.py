"""Dimensional warehouse toolkit for Spark: landing, dimension merges, facts, marts, checks."""
