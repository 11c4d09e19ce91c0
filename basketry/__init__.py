"""Retail order analytics as Spark DataFrame jobs."""
