"""Fare-card mobility analytics as Spark DataFrame jobs."""
