"""Queries composed of the operators, on the given test tables."""
