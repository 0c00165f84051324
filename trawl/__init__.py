"""Spark jobs for the data side of large web-collection projects."""
