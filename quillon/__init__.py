"""Quillon: match-archive analytics expressed as Spark DataFrame jobs."""
