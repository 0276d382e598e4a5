"""Electricity-market analytics as Spark DataFrame jobs."""
