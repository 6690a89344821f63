"""Vulnerability-fix analytics as Spark DataFrame jobs."""
