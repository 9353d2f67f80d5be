"""Facility energy-efficiency analytics as plain PySpark DataFrame plans."""
