"""Touring and setlist analytics as Spark DataFrame functions."""
