"""Whole runs put together from the operators."""
