"""Whole jobs and the query registry built from the operators."""
