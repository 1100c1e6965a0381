"""Operators that Spark does not offer as one call; each is DataFrame in, DataFrame out."""
