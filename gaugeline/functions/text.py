"""Keys cut from URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def after_marker(text: Column, marker: str = "cursor=") -> Column:
    """What follows the last ``marker``; the whole text where there is none."""
    return F.substring_index(text, marker, -1)


def last_segment(url: Column) -> Column:
    """The last path segment."""
    return F.substring_index(url, "/", -1)
