"""Composed models and reports."""
