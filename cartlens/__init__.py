"""Basket analytics and next-basket recommendation as PySpark DataFrame operators."""
