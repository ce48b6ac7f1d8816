"""Marketplace warehouse and analytics library on PySpark."""
