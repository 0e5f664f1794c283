"""Vistaloom: spatial-scene analytics and corpus preparation on PySpark."""
