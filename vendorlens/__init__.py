"""Vendor purchasing analytics as composable Spark DataFrame functions."""
