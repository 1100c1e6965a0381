"""Observation analytics as plain PySpark DataFrame functions."""
