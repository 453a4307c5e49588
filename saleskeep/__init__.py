"""Batch sales analytics on Spark: staging, quality rules, star schema, audit and OLAP."""

__version__ = "0.1.0"
