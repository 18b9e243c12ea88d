"""Listing analytics and corpus preparation on PySpark."""
