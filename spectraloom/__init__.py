"""Spark-first spectrum search, record transforms and table analytics."""
