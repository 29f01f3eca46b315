"""Amplicon sequencing analytics as Spark DataFrame jobs."""
