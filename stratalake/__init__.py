"""Layered (bronze, silver, gold) table and stream processing written for PySpark."""
