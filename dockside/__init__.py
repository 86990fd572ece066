"""Dimensional-warehouse operators expressed as plain PySpark DataFrame functions."""
