"""Whole workflows composed from the operators."""
