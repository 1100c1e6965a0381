"""The registered queries, the SQL they are compared with, and the adapter for the given tables."""
