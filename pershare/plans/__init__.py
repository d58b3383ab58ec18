"""Whole extraction plans built from the operators."""
